"""Collocations and quality rules against plain versions."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyboard.llm import collocations, quality_rules

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mined(rows, least, top=2000):
    f, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals["und" if lang is None else lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f["und" if lang is None else lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        found = []
        for p, a in candidates.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), " ".join(p), a, l, r, score))
        out += [(lang, rank, p, a, l, r, totals[lang], score) for rank, (_, _, _, p, a, l, r, score) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


FIELDS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("least,top,group_rows", [(2, 2000, 500_000), (3, 5, 7)])
def test_phrases_equal_plain_version(spark, least, top, group_rows):
    rows = [("a b c d e f, a b c d e f g! The cat the CAT\tthe cat  the cat", "en")] * 3
    rows += [("x x x x x x x; x x", "en"), ("a b c d. b c d e\nb c d e\rq", "de"), ("a b c d b c d", "de"), ("é ü é ü é ü é", None), ("é ü", "und"), (None, "en"), ("", None), (" . , ", ""), ("one two one two one two", "")]
    docs = spark.createDataFrame(rows * 2, "text string, lang string").repartition(3)
    got = collocations.mine_phrases(docs, least=least, top=top, group_rows=group_rows).select(*FIELDS).collect()
    assert sorted(map(tuple, got)) == mined(rows * 2, least, top)


def test_phrases_with_a_full_bitmap(spark, monkeypatch):
    """Rare words taken for frequent ones change nothing."""
    monkeypatch.setattr(collocations, "frequent_bits", lambda words, size=collocations.BITS: collocations.np.full(1 << (size - 3), 255, collocations.np.uint8))
    rows = [(f"rare{i} a b c rare{i} b c d", "en") for i in range(5)]
    got = collocations.mine_phrases(spark.createDataFrame(rows, "text string, lang string"), least=3).select(*FIELDS).collect()
    assert sorted(map(tuple, got)) == mined(rows, 3)


def test_paths_are_compacted(spark):
    """A sentence that always stands whole is one path; where it branches, the path ends."""
    rows = [("p q r s t u v w x y", "en")] * 4 + [("k l m n o", "en"), ("k l m n z", "en")] * 3
    got = {r.phrase: (r.path, r.path_words) for r in collocations.mine_phrases(spark.createDataFrame(rows, "text string, lang string"), least=3).collect()}
    assert got["s t u v"] == ("p q r s", 10) and got["p q r s"] == ("p q r s", 10) and got["k l m n"] == ("k l m n", 4)


def test_phrases_of_odd_rows(odd, none):
    rows = [(r.text, r.lang) for r in odd.select("text", "lang").collect()]
    got = collocations.mine_phrases(odd, least=2).select(*FIELDS).collect()
    assert sorted(map(tuple, got)) == mined(rows, 2)
    assert collocations.mine_phrases(none).count() == 0


def test_exact_score_beyond_64_bits(spark):
    big = 9_000_000_000_000_001
    counts = spark.createDataFrame([("en", "a", big), ("en", "b", big + 1), ("en", "a b", big)], "lang string, phrase string, n long")
    candidates = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, k int, a long")
    assert [r.score for r in collocations.score_cuts(candidates, counts, 1).collect()] == [2000000 * big // (2 * big + 1)]


def described(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {i + d for at in windows.values() if len(at) > 1 for i in at for d in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_rules_equal_plain_version(docs, odd):
    phrase = " ".join(f"w{i}" for i in range(12))
    more = [(1, f"{phrase} x {phrase} y"), (2, "a " * 40), (3, "l one\nl one \nl one\n\n \n\nl one"), (4, "#* $%&|<> 🙂\x0b\x0c漢字"), (5, "w " * 8), (6, "w " * 7), (7, f"{phrase} {phrase[:-4]}")]
    frame = docs.select("doc_id", "text", "lang").unionByName(odd.select("doc_id", "text", "lang")).unionByName(docs.sparkSession.createDataFrame([(*r, "en") for r in more], "doc_id long, text string, lang string"))
    want = sorted(((r.doc_id, *described(r.text)) for r in frame.collect()), key=str)
    assert sorted(map(tuple, quality_rules.apply_rules(frame).select(*BASE).collect()), key=str) == want


def test_rules_of_odd_rows(odd, none):
    got = quality_rules.apply_rules(odd).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((r.doc_id for r in odd.collect()), key=str)
    assert all(r.kept is not None and not (r.kept and r.base_failed) for r in got)
    assert quality_rules.apply_rules(none).count() == 0


def test_divergence(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    want = sum(0.5 * a * math.log2(a / c) for a, c in zip(p, m) if a) + sum(0.5 * a * math.log2(a / c) for a, c in zip(q, m) if a)
    arrays = [F.array(*map(F.lit, x)) for x in (p, q)]
    row = spark.range(1).select(quality_rules.divergence(*arrays), quality_rules.divergence(arrays[0], arrays[0]), quality_rules.divergence(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0)))).first()
    assert row[0] == pytest.approx(want) and row[1] == 0 and row[2] == pytest.approx(1)


def test_junk_goes_and_clean_texts_stay(spark, docs):
    """Symbols after every word, and a text without its language's common words; the same words in order stay."""
    clean = [r.text for r in docs.filter("lang = 'en' and n_chars between 1500 and 3000").orderBy("doc_id").limit(4).collect()]
    symbols = [" ".join(w + "###" for w in t.split()) for t in clean]
    listed = ["\n".join(f"xq{w}" for w in t.split()) for t in clean]
    rows = [(i, t, "en") for i, t in enumerate([*clean, *symbols, *listed])]
    references = quality_rules.fit_references(docs)
    kept = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), references).collect()}
    n = len(clean)
    assert not any(kept[i] for i in range(n, 3 * n))
    assert sum(kept[i] for i in range(n)) >= n - 1


def test_labelled_texts(spark):
    """Of texts labelled good, the histograms take few; of bad ones that pass the base rules, most."""
    from tallyboard.llm.common import table

    sf = "/root/testdata/sf0.01"
    got = quality_rules.apply_rules(table(spark, sf, "documents")).join(table(spark, sf, "labels"), "doc_id").filter("not base_failed")
    share = {r.quality: r.share for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.99 and share[0] < 0.2, share
