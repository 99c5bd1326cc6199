"""Token alignment against a plain version."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyboard.llm import token_alignment as ta

FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain(rows):
    """The contract read literally, with the two tokenizers' own libraries."""
    a = Tokenizer.from_file(f"{ta.TOKENIZERS}/{ta.A_FILE}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{ta.TOKENIZERS}/{ta.B_FILE}")
    letters = ta.byte_letters()

    def tokens_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") else p.replace("▁", " ").encode()

    docs = []
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a, raw_b = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a], [tokens_b(i) for i in ids_b]
        whole = (" " + (text or "")).encode()
        groups = []
        if text and b"".join(raw_a) == whole == b"".join(raw_b):
            ga, gb, pa_, pb = [], [], 0, 0
            ia = ib = 0
            while ia < len(ids_a) or ib < len(ids_b):
                if pa_ <= pb:
                    pa_, ga, ia = pa_ + len(raw_a[ia]), [*ga, ids_a[ia]], ia + 1
                else:
                    pb, gb, ib = pb + len(raw_b[ib]), [*gb, ids_b[ib]], ib + 1
                if pa_ == pb:
                    groups.append((ga, gb))
                    ga, gb = [], []
        docs.append((doc_id, groups))
    counts = Counter()
    for _, groups in docs:
        counts.update({(x, y) for ga, gb in groups for x in ga for y in gb})
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, groups in docs:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        spelled = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((doc_id, sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(spelled.encode()).hexdigest() if groups else ""))
    return out, counts


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_equals_plain_version(docs, texts):
    got = ta.align_tokens(docs).select(*FIELDS).collect()
    same(got, plain(texts)[0])


def test_small_blocks_give_the_same(docs, texts):
    got = ta.align_tokens(docs.repartition(3), block_bytes=20_000).select(*FIELDS).collect()
    same(got, plain(texts)[0])


TRICKY = [
    (1, "<|endoftext|> in a text </s> and <s>"),
    (2, "漢字かな交じり文 🙂🙃 naïve café"),
    (3, "  two  spaces\tand\ttabs\r\nand\n\n\nlines  "),
    (4, "a" * 9000 + " b " + "1" * 700 + " " * 5000 + "c"),
    (5, "▁ and ▁▁ stay"),
    (6, "ＦＵＬＬ ﬁ width"),
    (7, "\x00\x01 control"),
    (8, "it's we'll I'VE don't"),
    (8, "it's we'll I'VE don't"),
    (None, "no id"),
    (9, ""),
    (10, None),
    (11, " "),
]


def test_tricky_texts(spark):
    got = ta.align_tokens(spark.createDataFrame(TRICKY, "doc_id long, text string")).select(*FIELDS).collect()
    same(got, plain(TRICKY)[0])


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    same(ta.align_tokens(odd).select(*FIELDS).collect(), plain(rows)[0])


def test_empty_table(none):
    assert ta.align_tokens(none).count() == 0


def test_pairs_equal_plain_version(spark):
    got = {(r.a, r.b): (r["count"], r.best) for r in ta.linked_pairs(spark.createDataFrame(TRICKY, "doc_id long, text string")).collect()}
    counts = plain(TRICKY)[1]
    assert got == {p: (n, n == max(v for q, v in counts.items() if q[0] == p[0])) for p, n in counts.items()}


@pytest.mark.parametrize("links", [3, 1 << 21])
def test_wide_groups_are_expanded_in_parts(monkeypatch, links):
    monkeypatch.setattr(ta, "LINKS", links)
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 4, 60), rng.integers(0, 4, 50)
    cut_a, cut_b = np.array([1, 4, 30, 31, 60]), np.array([2, 3, 20, 49, 50])
    want, p, q = Counter(), 0, 0
    for i, j in zip(cut_a, cut_b):
        want.update((int(x), int(y)) for x in a[p:i] for y in b[q:j])
        p, q = i, j
    keys, n = ta.link(a, b, cut_a, cut_b)
    assert {(int(k) >> 32, int(k) & 0xFFFFFFFF): int(c) for k, c in zip(keys, n)} == want
