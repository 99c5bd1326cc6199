"""Exact, near and substring deduplication against plain versions."""

import hashlib
import random

import brute
import pytest
from pyspark.sql import functions as F

from tallyboard.llm import exact_dedup, jaccard_join, suffix_dedup
from tallyboard.llm.components import connected_components
from conftest import LONG, ROWS


def by_id(rows):
    return {r.doc_id: r for r in rows}


@pytest.mark.parametrize("options", [{}, {"key_bits": 3, "capacity": 4, "wanted_rows": 1}])
def test_exact(docs, texts, options):
    got = by_id(exact_dedup.exact_dedup(docs, **options).collect())
    groups = {}
    for i, t in texts:
        groups.setdefault("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""), []).append(i)
    for body, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(ids), len(ids), i == max(ids), hashlib.sha256(body.encode()).hexdigest())


def test_exact_odd_rows(odd, none):
    rows = exact_dedup.exact_dedup(odd).collect()
    assert len(rows) == len(ROWS)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in rows}
    assert got[1] == (2, 2, False) and got[2] == (2, 2, True)
    assert got[3] == (4, 2, False) and got[4] == (4, 2, True) and got[5] == (5, 1, True)
    assert got[6] == (7, 2, False) and got[None] == (None, 1, True) and got[9] == (9, 2, True)
    assert exact_dedup.exact_dedup(none).count() == 0
    kept = exact_dedup.keep_last_copies(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([2, 4, 5, 7, 8, None, 9, 10], key=str)
    assert exact_dedup.keep_last_copies(none).count() == 0


def test_directory_splits_only_overfull_buckets(spark):
    keys = spark.range(1000).select(F.shiftleft("id", 44).alias("key"))
    directory, depth = exact_dedup.build_directory(keys, 100)
    rows = directory.collect()
    loads = {}
    for r in keys.collect():
        cell = (r.key % (1 << 64)) >> (64 - depth)
        bucket = next(x.bucket for x in rows if x.cell == cell)
        loads[bucket] = loads.get(bucket, 0) + 1
    assert max(loads.values()) <= 100 and sum(loads.values()) == 1000


@pytest.mark.parametrize("options", [{}, {"block_classes": 2, "wanted": 0}])
def test_jaccard(docs, texts, options):
    got = by_id(jaccard_join.jaccard_join(docs, **options).collect())
    links, classes = brute.jaccard([t for _, t in texts])
    for (i, _), n, c in zip(texts, links, classes):
        assert (got[i].n_links, got[i].class_id) == (n, texts[c][0])
    assert sum(r.kept for r in got.values()) == len(set(classes))


def test_jaccard_dense_group_in_blocks(spark, odd):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        words = list(base)
        words[rng.randrange(120)] = f"x{i % 50}"
        texts.append(" ".join(words))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    links, classes = brute.jaccard(texts)
    for options in ({}, {"block_classes": 16, "block_shingles": 1500, "wanted": 0}):
        got = by_id(jaccard_join.jaccard_join(table, **options).collect())
        assert [got[i].n_links for i in range(60)] == links
        assert [got[i].class_id for i in range(60)] == classes


def test_jaccard_odd_rows(odd, none):
    rows = jaccard_join.jaccard_join(odd).collect()
    assert len(rows) == len(ROWS)
    got = {r.doc_id: (r.class_id, r.n_links, r.kept) for r in rows}
    assert got[1] == (1, 1, True) and got[2] == (1, 1, False)
    assert got[3] == (3, 0, True) and got[4] == (4, 0, True) and got[5] == (5, 0, True)
    assert got[6] == (6, 1, True) and got[7] == (6, 1, False) and got[9] == (9, 1, True)
    assert got[None] == (None, 0, True)
    kept = jaccard_join.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, 4, 5, 6, 8, None, 9, 10], key=str)
    assert jaccard_join.jaccard_join(none).count() == 0


def test_pruning_keeps_what_reaches_the_threshold():
    least = jaccard_join.least_agreements()
    assert [k for k, _ in least] == list(range(8, 121, 8))
    assert all(a <= b for (_, a), (_, b) in zip(least, least[1:]))
    assert least[-1][1] < 0.8 * 120


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(1, 80)]
    up = {}

    def root(i):
        up.setdefault(i, i)
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in up if any(i in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


SMALL = dict(length=48, gram=8)


@pytest.mark.parametrize("options", [{}, SMALL, {**SMALL, "group_contexts": 2, "range_nodes": 200, "run_bytes": 1 << 18, "wanted_nodes": 0, "wanted_spans": 0}, {**SMALL, "hot_nodes": 3, "run_bytes": 1 << 18}])
def test_repeats(docs, texts, options):
    got = by_id(suffix_dedup.remove_repeats(docs, **options).collect())
    for (i, t), want in zip(texts, brute.repeats([t for _, t in texts], options.get("length", 400))):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want
        assert len(r.kept) == r.n_bytes - r.n_removed


def test_repeats_of_periods_and_edits(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdef") for _ in range(rng.randrange(2, 7))) for _ in range(300)]
    passage = " ".join(words[:30])
    made = ["a" * 700, "ab" * 300, passage, passage[:60], "x" + passage, passage + "y"]
    for _ in range(30):
        lead, tail = (" ".join(rng.choices(words, k=rng.randrange(0, 9))) for _ in range(2))
        cut = rng.randrange(0, 60)
        made.append(lead + passage[cut : cut + rng.randrange(40, 120)] + tail)
    table = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    for options in (SMALL, {**SMALL, "group_contexts": 3}, {**SMALL, "hot_nodes": 2}, {**SMALL, "hot_nodes": 1, "run_bytes": 1_000}):
        got = by_id(suffix_dedup.remove_repeats(table, **options).collect())
        for i, want in enumerate(brute.repeats(made, 48)):
            assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want


def test_repeats_odd_rows(odd, none):
    rows = suffix_dedup.remove_repeats(odd, kept=False).collect()
    assert len(rows) == len(ROWS)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in rows}
    size = len(LONG.encode())
    assert got[6] == got[7] == (size, size, 1)
    assert got[3] == got[4] == (0, 0, 0) and got[None][1] == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
