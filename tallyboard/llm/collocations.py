"""Phrases whose words stand together more often than their parts do, from a weighted de Bruijn graph.

Nodes are runs of three words, edges the runs of four that overlap in them. One pass over
the texts counts every word. The last one emits, for each word, the longest run from it: an
edge, or a shorter run where its piece ends. These are aggregated once; counts of shorter
phrases are the flow out of a node plus the runs that end there, so no length but the
longest is counted in the texts. Stretches of edges without a branch are compacted into paths.

Words and pairs of words that occur less than ``least`` times cannot be in a candidate, so
the last pass ends pieces at them. It knows them from bitmaps of fixed size: of the words
counted, and of places that pairs are counted by in a pass between. What shares a place
with something frequent costs work only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.session import last_read, settle
from .common import answer, slices, utf8
from .wordhash import LOWER, find_words, hash_spans, mix

LEAST = 30
"""Occurrences of a candidate."""
TOP = 2000
SHARE = 80
"""A phrase is dropped if a longer one has this percentage of its occurrences."""
LONGEST = 4
BITS = 26
"""Places in the bitmap of frequent words: 2 ** 26 bits are 8 MB."""
PAIR_BITS = 27
"""Places that pairs of words are counted by; the bitmap of the frequent ones has 16 MB."""
_CELL = 15
"""A row of a bitmap has 2 ** 15 bits."""
FLUSH_BYTES, FLUSH_PAIRS = 4 << 20, 2_000_000
ENDS_PIECE = np.array([chr(c) in ".,;:!?" or 0x0A <= c <= 0x0D for c in range(256)])
ENDS_WORD = ENDS_PIECE | np.array([c in (0x20, 0x09) for c in range(256)])


def _languages(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The batch's languages, the number of each row's, and a hash of each."""
    coded = batch.column("lang").dictionary_encode()
    names = coded.dictionary.to_pylist()
    raw = [n.encode() for n in names]
    ends = np.cumsum([len(r) for r in raw])
    return names, coded.indices.to_numpy(), hash_spans(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends)


_COUNTED = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def _counted(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    """Words with counts; one row without a word counts all of a language."""
    for lang, words in counts.items():
        raw, n = list(words), np.fromiter(words.values(), np.int64, len(words))
        yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(raw) + 1)), pa.array([*(w.decode("utf-8", "replace") for w in raw), None], pa.string()), pa.array(np.append(n, n.sum()))], schema=_COUNTED)


def _places(words: np.ndarray, salts: np.ndarray, bits: int = BITS) -> np.ndarray:
    return (mix(words ^ salts) >> np.uint64(64 - bits)).astype(np.int64)


def _set(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def count_words(rows: DataFrame) -> DataFrame:
    """lang, word and count; the row without a word counts all words of the language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        held = 0
        for batch in batches:
            names, of, _ = _languages(batch)
            for begin, _, data, offsets in slices(batch.column("body")):
                starts, ends, first = find_words(data, offsets, ENDS_WORD)
                lowered = LOWER[data].tobytes()
                words = [lowered[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                cuts = first.tolist()
                for row, (i, j) in enumerate(zip(cuts, cuts[1:])):
                    counts.setdefault(names[of[begin + row]], Counter()).update(words[i:j])
                held += len(data)
                if held > FLUSH_BYTES:
                    yield from _counted(counts)
                    counts, held = {}, 0
        yield from _counted(counts)

    return rows.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def word_places(words: DataFrame) -> DataFrame:
    """The place of each word in the bitmap."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, of, salts = _languages(batch)
            for begin, end, data, offsets in slices(batch.column("word")):
                yield pa.RecordBatch.from_arrays([pa.array(_places(hash_spans(data, offsets[:-1], offsets[1:]), salts[of[begin:end]]))], names=["place"])

    return words.select("lang", utf8(F.col("word")).alias("word")).mapInArrow(place, "place long")


def frequent_bits(words: DataFrame, size: int = BITS) -> np.ndarray:
    """The bitmap of the rows' places: 2 ** (size - 15) rows of 4 KB at most come to the driver."""
    cells = words.groupBy(F.shiftright("place", _CELL).alias("cell")).agg(F.call_function("bitmap_construct_agg", F.col("place").bitwiseAND((1 << _CELL) - 1)).alias("bits"))
    bits = np.zeros((1 << (size - _CELL), (1 << _CELL) // 8), np.uint8)
    rows = last_read(cells)
    for cell, raw in zip(rows.column("cell").to_pylist(), rows.column("bits").to_pylist()):
        bits[cell, : len(raw)] = np.frombuffer(raw, np.uint8)
    return bits.ravel()


def _linked(data: np.ndarray, offsets: np.ndarray, salts: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end and text of every word; the words followed in their piece by one that is frequent as they are, and the places of these pairs."""
    starts, ends, first = find_words(data, offsets, ENDS_WORD)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    hashes = hash_spans(data, starts, ends)
    common = _set(bits, _places(hashes, salts[row]))
    pieces = np.concatenate([[0], np.cumsum(ENDS_PIECE[data])])
    linked = np.flatnonzero(common[:-1] & common[1:] & (row[:-1] == row[1:]) & (pieces[starts[1:]] == pieces[ends[:-1]]))
    pairs = _places(hashes[linked] * _FIRST + hashes[linked + 1], salts[row[linked]], PAIR_BITS)
    return starts, ends, row, linked, pairs


_FIRST = np.uint64(0xD6E8FEB86659FD93)


def count_pairs(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """place and count of the pairs of frequent words; pairs that share a place are counted together."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        places, n = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), pa.array(n.astype(np.int32))], names=["place", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            _, of, hashes = _languages(batch)
            for begin, end, data, offsets in slices(batch.column("body")):
                held.append(_linked(data, offsets, hashes[of[begin:end]], shared.value)[4])
                if sum(map(len, held)) > FLUSH_PAIRS:
                    yield flush(held)
                    held = []
        yield flush(held)

    return rows.mapInArrow(count, "place int, n int").groupBy("place").agg(F.sum("n").alias("n"))


def _runs(data: np.ndarray, offsets: np.ndarray, salts: np.ndarray, bits: np.ndarray, pair_bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every word that starts a frequent pair: its text's row, the words and text of the longest run from it, and where those texts end."""
    starts, ends, row, linked, pairs = _linked(data, offsets, salts, bits)
    goes_on = np.zeros(len(starts) + LONGEST, bool)
    goes_on[linked[_set(pair_bits, pairs)]] = True
    words, so_far = np.ones(len(starts), np.int64), np.ones(len(starts), bool)
    for k in range(LONGEST - 1):
        so_far &= goes_on[k : k + len(starts)]
        words += so_far
    # the words once more, lower-cased and with one space after each
    sizes = ends - starts + 1
    begins = np.concatenate([[0], np.cumsum(sizes)])
    spaced = np.append(LOWER[data], np.uint8(32))[np.repeat(starts - begins[:-1], sizes) + np.arange(begins[-1])]
    spaced[begins[1:] - 1] = 32
    at = np.flatnonzero(words > 1)
    length = begins[at + words[at]] - 1 - begins[at]
    out = np.concatenate([[0], np.cumsum(length)])
    return row[at], words[at], spaced[np.repeat(begins[at] - out[:-1], length) + np.arange(out[-1])], out


def emit_runs(rows: DataFrame, bits: np.ndarray, pair_bits: np.ndarray) -> DataFrame:
    """lang, run, k: for each word the longest run of frequent pairs from it, of two to four words."""
    shared = rows.sparkSession.sparkContext.broadcast((bits, pair_bits))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, of, hashes = _languages(batch)
            for begin, end, data, offsets in slices(batch.column("body")):
                row, words, text, ends = _runs(data, offsets, hashes[of[begin:end]], *shared.value)
                for lo in range(0, len(row), 50_000):
                    n = min(50_000, len(row) - lo)
                    cut = ends[lo : lo + n + 1]
                    run = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer((cut - cut[0]).astype("<i4").tobytes()), pa.py_buffer(text[cut[0] : cut[-1]].tobytes())])
                    lang = pa.DictionaryArray.from_arrays(pa.array(of[begin + row[lo : lo + n]].astype(np.int32)), pa.array(names, pa.string())).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([lang, run, pa.array(words[lo : lo + n].astype(np.int8))], names=["lang", "run", "k"])

    return rows.mapInArrow(emit, "lang string, run string, k byte")


def count_phrases(runs: DataFrame, least: int) -> DataFrame:
    """lang, phrase, k and count of all phrases of two to four words with at least ``least`` occurrences.

    Edges are summed first. A phrase of three is summed over the edges that leave it and
    the runs of three that end there, one of two over those of three and the runs of two.
    Each branch asks for the whole of an aggregate, so that it is computed once.
    """
    edges = runs.groupBy("lang", F.col("run").alias("phrase"), "k").agg(F.count("*").alias("n"))
    nodes = edges.groupBy("lang", F.substring_index("phrase", " ", 3).alias("phrase"), F.least("k", F.lit(3)).alias("k")).agg(F.sum("n").alias("n"))
    twos = nodes.groupBy("lang", F.substring_index("phrase", " ", 2).alias("phrase")).agg(F.sum("n").alias("n")).withColumn("k", F.lit(2))

    def enough(counted: DataFrame, k: int) -> DataFrame:
        return counted.filter(F.when(F.col("n") >= least, F.col("k")) == k).select("lang", "phrase", F.col("k").cast("int").alias("k"), "n")

    return enough(edges, 4).unionAll(enough(nodes, 3)).unionAll(enough(twos, 2))


def compact_paths(phrases: DataFrame) -> DataFrame:
    """lang, phrase, path (its first edge) and path_words of every edge, the longest stretch without a branch around it.

    An edge leads on to the next if both have the count of the node between: then every
    occurrence of one is followed by the other. Edges find the start of their path by
    doubling the distance they look back, so rounds grow with the logarithm of the longest.
    """
    edges = phrases.filter("k = 4").select("lang", "phrase", "n", F.substring_index("phrase", " ", 3).alias("tail"), F.substring_index("phrase", " ", -3).alias("head"))
    nodes = phrases.filter("k = 3").select("lang", F.col("phrase").alias("node"), "n")
    into = edges.select("lang", F.col("head").alias("node"), "n", F.col("phrase").alias("before")).join(nodes, ["lang", "node", "n"])
    back = into.withColumnRenamed("node", "tail")
    now = settle(edges.join(back, ["lang", "tail", "n"], "left").select("lang", "phrase", F.coalesce("before", "phrase").alias("up"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("far"), F.col("before").isNull().alias("done")))
    while now.filter("not done").take(1):
        there = now.select("lang", F.col("phrase").alias("up"), F.col("up").alias("above"), F.col("far").alias("more"), F.col("done").alias("ended"))
        stepped = now.filter("not done").join(there, ["lang", "up"]).select("lang", "phrase", F.col("above").alias("up"), (F.col("far") + F.col("more")).alias("far"), F.col("ended").alias("done"))
        now = settle(now.filter("done").unionAll(stepped))
    return settle(now.select("lang", "phrase", F.col("up").alias("path"), "far"))


def path_sizes(paths: DataFrame) -> DataFrame:
    """lang, path and path_words, the number of words of the path."""
    return paths.groupBy("lang", "path").agg((F.max("far") + LONGEST).alias("path_words"))


def _looked_up(rows: DataFrame, counts: DataFrame, part: str, out: str, total: int) -> DataFrame:
    """Put the count of the phrase in column ``part`` on each row."""
    sizes = rows.groupBy("lang", part).agg(F.count("*").alias("size"))
    groups = counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(out)).join(sizes, ["lang", part])
    return answer(rows, groups, ["lang", part], [out], "size", total)


def score_cuts(candidates: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """Candidates with l, r and score of the cut that scores lowest, the first such one."""
    cuts = candidates.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', cut)"), "right": F.expr("substring_index(phrase, ' ', cut - k)")})
    both = _looked_up(_looked_up(cuts, counts, "left", "l", 3 * total), counts, "right", "r", 3 * total)
    score = F.expr("cast((cast(2000000 as decimal(10,0)) * cast(a as decimal(20,0))) div cast(l + r as decimal(20,0)) as long)")
    return both.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")).select("lang", "phrase", "k", "a", "best.l", "best.r", "best.score")


def covered(candidates: DataFrame) -> DataFrame:
    """lang, phrase and the highest count of a longer candidate that it lies in."""
    words, k = F.split("phrase", " "), F.col("k")
    inside = F.flatten(F.transform(F.sequence(F.lit(2), k - 1), lambda m: F.transform(F.sequence(F.lit(1), k - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))
    return candidates.filter("k > 2").select("lang", F.explode(inside).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, share: int = SHARE, group_rows: int = 500_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, path and path_words: each language's ``top`` phrases.

    A-Z is lower-cased; a null language is ``und``, a null or empty text has no words.
    Repeated rows count as often as they occur. Ties in score go by count, then by the
    phrase's bytes. ``path`` is the first edge of the stretch that always surrounds a
    phrase of four words and ``path_words`` the stretch's length; a shorter phrase is its
    own path. A language without candidates has no rows, an empty table gives an empty result.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), utf8(F.col(text)).alias("body"))
    words = settle(count_words(rows).filter((F.col("n") >= least) | F.col("word").isNull()))
    singles, totals = words.filter("word is not null and n >= %d" % least), words.filter("word is null").select("lang", F.col("n").alias("n_words"))
    bits = frequent_bits(word_places(singles))
    pair_bits = frequent_bits(count_pairs(rows, bits).filter(F.col("n") >= least), PAIR_BITS)
    phrases = settle(count_phrases(emit_runs(rows, bits, pair_bits), least))
    candidates = phrases.withColumnRenamed("n", "a")
    total = candidates.count()
    paths = compact_paths(phrases)

    counts = phrases.select("lang", "phrase", "n").unionAll(singles.select("lang", F.col("word").alias("phrase"), "n"))
    scored = score_cuts(candidates, counts, total)
    longer = covered(candidates)
    left = scored.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(total // group_rows + 1))
    few = left.withColumn("bucket", bucket).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*best))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top)
    with_path = ranked.join(paths.select("lang", "phrase", "path").join(path_sizes(paths), ["lang", "path"]), ["lang", "phrase"], "left")
    return with_path.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("n_words").alias("n"), "score", F.coalesce("path", "phrase").alias("path"), F.coalesce("path_words", F.col("k").cast("long")).alias("path_words"))


ORACLE = r"""
WITH RECURSIVE pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM split),
grams AS MATERIALIZED (
  SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase, count(*)::BIGINT AS f
  FROM starts, (VALUES (1), (2), (3), (4)) AS t(k) WHERE i + k - 1 <= len(ws)
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS ws FROM grams WHERE f >= 30),
cuts AS (SELECT lang, phrase, k, f AS a, ws, unnest(range(1, k)) AS cut FROM often WHERE k > 1),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, x.f AS l, y.f AS r, c.cut, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
  FROM cuts c
  JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[:c.cut], ' ')
  JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, f, array_to_string(ws[s.i:s.i + s.m - 1], ' ') AS phrase
  FROM often, (SELECT m, i FROM (VALUES (2), (3)) AS u(m), (VALUES (1), (2), (3)) AS v(i)) AS s
  WHERE k > 2 AND s.m < k AND s.i + s.m - 1 <= k),
longer AS (SELECT lang, phrase, max(f) AS f FROM parts GROUP BY ALL),
remaining AS (SELECT o.* FROM lowest o LEFT JOIN longer g USING (lang, phrase) WHERE g.f IS NULL OR 100 * g.f < 80 * o.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM remaining),
edges AS MATERIALIZED (SELECT lang, phrase, f, array_to_string(ws[1:3], ' ') AS tail, array_to_string(ws[2:4], ' ') AS head FROM often WHERE k = 4),
steps AS MATERIALIZED (
  SELECT a.lang, a.phrase, b.phrase AS next FROM edges a JOIN often v ON v.lang = a.lang AND v.phrase = a.head AND v.f = a.f
  JOIN edges b ON b.lang = a.lang AND b.tail = a.head AND b.f = a.f),
walk AS (
  SELECT lang, phrase AS path, phrase, 4::BIGINT AS far FROM edges e WHERE NOT EXISTS (SELECT 1 FROM steps s WHERE s.lang = e.lang AND s.next = e.phrase)
  UNION ALL
  SELECT w.lang, w.path, s.next, w.far + 1 FROM walk w JOIN steps s ON s.lang = w.lang AND s.phrase = w.phrase),
sizes AS (SELECT lang, path, max(far) AS path_words FROM walk GROUP BY ALL)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score, coalesce(w.path, r.phrase) AS path, coalesce(s.path_words, r.k)::BIGINT AS path_words
FROM ranked r JOIN totals t USING (lang) LEFT JOIN walk w ON w.lang = r.lang AND w.phrase = r.phrase LEFT JOIN sizes s ON s.lang = w.lang AND s.path = w.path
WHERE r.rank <= 2000
"""
