"""Remove byte strings that repeat, by a distributed merge sort of suffixes.

Not every suffix is sorted. Each string of LENGTH bytes has an anchor, the GRAM bytes in it with
the smallest hash (the first of equals), so equal strings have their anchors at the same
offset. Neighbouring starts with one anchor make a node. Nodes whose anchor bytes occur
once cannot repeat and go. The others' suffixes from the anchor on, followed by the
bytes before the anchor read backwards, are sorted in runs, exchanged front-coded and merged
by loser trees. In sorted order the prefix shared with the suffix before gives how far two
nodes agree after their anchors; nodes are joined from the longest such prefix down, and
neighbours in the order of their backward parts give how far they agree before it. That
decides every start exactly without comparing all pairs.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.session import settle
from .common import answer, slices, utf8
from .merge import RUN_BYTES, combine_ranges, common, cut_run, decode, merge, pick_splitters
from .wordhash import mix

LENGTH, GRAM = 400, 64
RANGE_NODES = 30_000
GROUP_CONTEXTS = 20_000
"""A group of nodes with one anchor is decided in its task up to this many different contexts, else string by string."""
HOT_NODES = 200_000
"""Nodes with an anchor that more nodes than this have are kept out of the merge and decided string by string."""
APART = -1
"""The range of such nodes' runs; no task brings it together."""
WANTED_NODES = 100_000
"""Most nodes (16 bytes each, plus 24 a document) that are broadcast to the documents; beyond it that join is shuffled."""
WANTED_SPANS = 100_000
SAMPLE = 64
"""One anchor in this many sends its bytes, to find the ranges."""
_END = b"\xff"
"""Stands between the two parts of a suffix; no byte of UTF-8 text equals it."""
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of every ``gram`` bytes, a power of two, by doubling."""
    h, size = _TABLE[data], 1
    factor = 0x9E3779B97F4A7C15
    while size < gram:
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor = factor * factor % (1 << 64)
        size *= 2
    return mix(h)


def sliding_first_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value in every window, by running minima of blocks from both sides."""
    ranked = (values & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=np.uint64)
    blocks = -(-len(ranked) // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(ranked)] = ranked
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(ranked) - width + 1
    return (np.minimum(back[:count], ahead[width - 1 : width - 1 + count]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def find_nodes(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Text, first start, last start, anchor (all from the text's beginning) and anchor hash of every node."""
    nothing = np.zeros(0, np.int64)
    sizes = np.diff(offsets)
    if len(data) < length or not (sizes >= length).any():
        return nothing, nothing, nothing, nothing, np.zeros(0, np.uint64)
    hashes = gram_hashes(data, gram)
    anchors = sliding_first_minimum(hashes, length - gram + 1)
    runs = np.maximum(0, sizes - length + 1)
    starts = np.repeat(offsets[:-1] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
    of = np.repeat(np.arange(len(sizes)), runs)
    at = anchors[starts]
    cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (of[1:] != of[:-1])]))
    last = np.concatenate([cut[1:], [len(starts)]]) - 1
    text = of[cut]
    return text, starts[cut] - offsets[text], starts[last] - offsets[text], at[cut] - offsets[text], hashes[at[cut]]


def decide(keys: list[bytes], shared: list[int], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For nodes with one anchor and different contexts, in sorted order: offsets (low, high) of starts that repeat.

    ``keys`` are suffix, end mark and backward part, ``shared`` the prefix in common with
    the key before. A start at offset o repeats if another node agrees on length - o
    bytes after the anchor and on o bytes before it.
    """
    ahead = [k.rindex(_END) for k in keys]
    lefts = [k[n + 1 :] for k, n in zip(keys, ahead)]
    agree = [0, *(min(shared[i], ahead[i - 1], ahead[i]) for i in range(1, len(keys)))]
    found: list[list[tuple[int, int]]] = [[] for _ in keys]
    group = list(range(len(keys)))
    members = [[(left, i)] for i, left in enumerate(lefts)]

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = i = group[group[i]]
        return i

    def note(i: int, right: int, left: int) -> None:
        low, high = max(length - right, length - ahead[i]), min(left, len(lefts[i]))
        if low <= high:
            found[i].append((low, high))

    for i in sorted(range(1, len(keys)), key=lambda i: -agree[i]):
        a, b = root(i - 1), root(i)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large = members[a]
        for entry in members[b]:
            at = bisect.bisect_left(large, entry)
            for other in large[max(0, at - 1) : at + 1]:
                left = common(entry[0], other[0], 0)
                note(entry[1], agree[i], left)
                note(other[1], agree[i], left)
            large.insert(at, entry)
        group[b], members[b] = a, []
    return [_joined(f) for f in found]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, a hash of the bytes, and the bytes: rows alike in the first two are the same text."""
    body = utf8(F.col(text))
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("name"), F.xxhash64(body).alias("h"), body.alias("body"))


_ANCHORS = "name string, h long, first int, last int, anchor int, gram long, sample binary"


def _anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, _, data, offsets in slices(batch.column("body")):
                of, first, last, anchor, hashes = find_nodes(data, offsets, length, gram)
                rows_ = pa.array(of + begin)
                chosen = (hashes % np.uint64(SAMPLE) == 0).tolist()
                places = (offsets[of] + anchor).tolist()
                sample = pa.array([data[p : p + gram].tobytes() if c else None for c, p in zip(chosen, places)], pa.binary())
                numbers = [pa.array(x.astype(np.int32)) for x in (first, last, anchor)]
                yield pa.RecordBatch.from_arrays([batch.column("name").take(rows_), batch.column("h").take(rows_), *numbers, pa.array(hashes.view(np.int64)), sample], names=["name", "h", "first", "last", "anchor", "gram", "sample"])

    return rows.select("name", "h", "body").mapInArrow(find, _ANCHORS)


_RUNS = "range int, run string, blob binary, refs binary"


def _runs(rows: DataFrame, splitters: list[bytes], length: int, gram: int, run_bytes: int) -> DataFrame:
    """Sorted runs of different contexts per task, those of hot anchors as a piece in APART.

    ``refs`` holds, for the place of a context in its piece, the rows it came from.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[tuple[int, int]]] = {}
        names: dict[tuple[str, int], int] = {}
        hot: set[bytes] = set()
        size = 0

        def flush() -> pa.RecordBatch:
            run, out = uuid.uuid4().hex, []
            listed = list(names)
            items = [(key, b"2" if len(refs) > 1 else b"1") for key, refs in held.items()]
            apart = cut_run([i for i in items if i[0] in hot], [])
            for number, blob in [*cut_run([i for i in items if i[0] not in hot], splitters), *((APART, blob) for _, blob in apart)]:
                refs = [(place, *ref) for place, (key, _, _) in enumerate(decode(blob)) for ref in held[key]]
                used = sorted({r[1] for r in refs})
                packed = np.array([(p, bisect.bisect_left(used, n), a) for p, n, a in refs], np.int32).tobytes()
                out.append((number, run, blob, _pack([listed[n] for n in used], packed)))
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out]), *(pa.array([o[k] for o in out], pa.binary()) for k in (2, 3))], names=["range", "run", "blob", "refs"])

        for batch in batches:
            for name, h, body, nodes in zip(batch.column("name").to_pylist(), batch.column("h").to_pylist(), batch.column("body"), batch.column("nodes").to_pylist()):
                raw = body.as_py()
                number = names.setdefault((name, h), len(names))
                for node in nodes:
                    first, last, anchor = node["first"], node["last"], node["anchor"]
                    key = raw[anchor : last + length] + _END + raw[first:anchor][::-1]
                    if key not in held:
                        held[key] = []
                        size += len(key) + 200
                    held[key].append((number, anchor))
                    size += 100
                    if node["hot"]:
                        hot.add(key)
                if size > run_bytes:
                    yield flush()
                    held, names, size = {}, {}, 0
                    hot.clear()
        if held:
            yield flush()

    return rows.mapInArrow(build, _RUNS)


def _pack(names: list[tuple[str, int]], refs: bytes) -> bytes:
    text = "\n".join(f"{n} {h}" for n, h in names).encode()
    return np.uint32(len(text)).tobytes() + text + refs


def _unpack(packed: bytes) -> tuple[list[tuple[str, int]], np.ndarray]:
    size = int(np.frombuffer(packed, np.uint32, 1)[0])
    lines = packed[4 : 4 + size].decode().split("\n")
    names = [(line.rpartition(" ")[0], int(line.rpartition(" ")[2])) for line in lines]
    return names, np.frombuffer(packed, np.int32, -1, 4 + size).reshape(-1, 3)


_DECISIONS = "range int, run string, place int, low int, high int, context binary"


def _made(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["range", "run", "place", "low", "high", "context"])


def _whole(key: bytes, length: int) -> tuple[int, int]:
    """Offsets of the first and last start of a context."""
    ahead = key.rindex(_END)
    return length - ahead, len(key) - ahead - 1


def _apart(runs: DataFrame, length: int) -> DataFrame:
    """The contexts of the pieces in APART; one that is in its run more than once repeats in all its starts."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, blob in zip(batch.column("run").to_pylist(), batch.column("blob")):
                out: list[tuple] = []
                for place, (key, _, value) in enumerate(decode(blob.as_py())):
                    spans = _whole(key, length)
                    if value == b"2":
                        out.append((APART, run, place, *spans, None))
                    out.append((APART, run, place, *spans, key))
                    if len(out) > 5_000:
                        yield _made(out)
                        out = []
                if out:
                    yield _made(out)

    return runs.filter(F.col("range") == APART).select("run", "blob").mapInArrow(unpack, _DECISIONS)


def _decisions(runs: DataFrame, length: int, gram: int, group_contexts: int) -> DataFrame:
    """Offsets of repeated starts per place in a run; of groups too large for a task, the contexts themselves."""

    def handle(number: int, pieces: list[tuple[str, bytes]]) -> Iterator[pa.RecordBatch]:
        names = [run for run, _ in pieces]
        out: list[tuple] = []

        def tagged(run: int, blob: bytes) -> Iterator[tuple[bytes, int, tuple[int, int, bytes]]]:
            for place, (key, prefix, value) in enumerate(decode(blob)):
                yield key, prefix, (run, place, value)

        keys: list[bytes] = []
        shared: list[int] = []
        refs: list[list[tuple[int, int]]] = []
        many: list[bool] = []
        hot = False

        def close(more: bool) -> None:
            """Put out what is known of the group; ``more`` says that it goes on."""
            nonlocal hot
            hot = hot or more
            found = [[] for _ in keys] if hot or len(keys) == 1 else decide(keys, shared, length)
            for key, spans, places, repeats in zip(keys, found, refs, many):
                if repeats:
                    spans = [_whole(key, length)]
                out.extend((number, names[run], place, low, high, None) for run, place in places for low, high in spans)
                if hot:
                    run, place = places[0]
                    out.append((number, names[run], place, *_whole(key, length), key))
            keys.clear(), shared.clear(), refs.clear(), many.clear()
            hot = more

        for key, prefix, (run, place, value) in merge(tagged(k, blob) for k, (_, blob) in enumerate(pieces)):
            if keys and prefix == len(key) == len(keys[-1]):
                refs[-1].append((run, place))
                many[-1] = True
                continue
            if prefix < gram:
                close(False)
            elif len(keys) >= group_contexts:
                close(True)
            if len(out) > 20_000:
                yield _made(out)
                out.clear()
            keys.append(key)
            shared.append(prefix)
            refs.append([(run, place)])
            many.append(value == b"2")
        close(False)
        if out:
            yield _made(out)

    return combine_ranges(runs.filter(F.col("range") != APART), handle, _DECISIONS)


def _string_by_string(contexts: DataFrame, length: int) -> DataFrame:
    """Decisions for contexts of very large groups, from a digest of each of their strings."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                key = row["context"]
                ahead = key.rindex(_END)
                whole, low, high = key[ahead + 1 :][::-1] + key[:ahead], row["low"], row["high"]
                prints = [hashlib.blake2b(whole[high - o : high - o + length], digest_size=16).digest() for o in range(low, high + 1)]
                n = len(prints)
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array([row["range"]] * n, pa.int32()), pa.array([row["run"]] * n), pa.array([row["place"]] * n, pa.int32()), pa.array(range(low, high + 1), pa.int32())], names=["print", "range", "run", "place", "low"])

    strings = settle(contexts.mapInArrow(cut, "print binary, range int, run string, place int, low int"))
    counts = strings.groupBy("print").agg(F.count("*").alias("n")).filter("n > 1")
    found = answer(strings, counts, ["print"], ["n"], "n", strings.count()).filter("n is not null")
    return found.select("range", "run", "place", "low", F.col("low").alias("high"))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, group_contexts: int = GROUP_CONTEXTS, range_nodes: int = RANGE_NODES, run_bytes: int = RUN_BYTES, wanted_nodes: int = WANTED_NODES, hot_nodes: int = HOT_NODES) -> DataFrame:
    """name, h and the spans (begin, end) of bytes in strings of ``length`` bytes that start anywhere else too."""
    rows = _keyed(docs, doc_id, text)
    anchors = settle(_anchors(rows, length, gram))
    total = anchors.count()
    grams = settle(anchors.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"))
    repeated = settle(answer(anchors, grams, ["gram"], ["n"], "n", total).filter("n is not null"))
    count = repeated.count()
    ranges = math.ceil(count / range_nodes)
    splitters = pick_splitters(repeated.filter("sample is not null").select("sample"), ranges)

    nodes = repeated.groupBy("name", "h").agg(F.collect_list(F.struct("first", "last", "anchor", (F.col("n") > hot_nodes).alias("hot"))).alias("nodes"))
    wanted = F.broadcast(nodes) if count <= wanted_nodes else nodes
    chosen = rows.select("name", "h", "body").join(wanted, ["name", "h"])
    runs = settle(_runs(chosen, splitters, length, gram, run_bytes))
    made = _decisions(runs, length, gram, group_contexts)
    if not grams.filter(F.col("n") > hot_nodes).isEmpty():
        made = made.unionByName(_apart(runs, length))
    made = settle(made)
    decided = made.filter("context is null").drop("context")
    large = made.filter("context is not null")
    if not large.isEmpty():
        decided = decided.unionByName(_string_by_string(large, length))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, offsets in zip(batch.column("refs"), batch.column("offsets").to_pylist()):
                names, refs = _unpack(packed.as_py())
                by_place: dict[int, list[tuple[int, int]]] = {}
                for o in offsets:
                    by_place.setdefault(o["place"], []).append((o["low"], o["high"]))
                out = [(*names[n], anchor - high, anchor - low + length) for p, n, anchor in refs.tolist() for low, high in _joined(by_place.get(p, []))]
                columns = list(zip(*out)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())], names=["name", "h", "begin", "end"])

    offsets = decided.groupBy("range", "run").agg(F.collect_list(F.struct("place", "low", "high")).alias("offsets"))
    placed = runs.select("range", "run", "refs").join(offsets, ["range", "run"]).select("refs", "offsets").mapInArrow(place, "name string, h long, begin int, end int")
    return placed.groupBy("name", "h").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
_RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", kept: bool = True, wanted_spans: int = WANTED_SPANS, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if ``kept``, the bytes left, per row of ``docs``.

    Texts are UTF-8 bytes, null is empty. A byte goes if a string of ``length`` bytes
    over it also starts anywhere else, in the same text or another; overlaps count, and
    strings are judged on the input. Rows that repeat id and text are texts of their own, so
    their long strings go. Texts shorter than ``length`` stay whole, an empty table gives
    an empty result. Memory grows with the longest text, about 80 bytes per byte.
    """
    rows = _keyed(docs, doc_id, text)
    spans = settle(repeated_spans(docs, doc_id, text, **options))
    count = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    joined = rows.join(F.broadcast(spans) if count <= wanted_spans else spans, ["name", "h"], "left").select("id", "body", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for i, body, spans_ in zip(batch.column("id").to_pylist(), batch.column("body"), batch.column("spans").to_pylist()):
                raw, at, removed, n, pieces = body.as_py(), 0, 0, 0, []
                for begin, end in _joined([(s["begin"], s["end"] - 1) for s in spans_ or []]):
                    pieces.append(raw[at:begin])
                    at, removed, n = end + 1, removed + end + 1 - begin, n + 1
                left = b"".join([*pieces, raw[at:]])
                out.append((i, len(raw), removed, n, hashlib.sha256(left).hexdigest(), left if kept else None))
                size += len(left) if kept else 0
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT_ARROW)], schema=_RESULT_ARROW)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT_ARROW)], schema=_RESULT_ARROW)

    return joined.mapInArrow(cut, _RESULT)
