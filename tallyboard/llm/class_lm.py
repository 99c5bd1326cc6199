"""Scoring text with a Brown class-based n-gram model.

All words of the training documents are counted and clustered, so that neighbouring classes
tell most about each other. The start is an exchange over items: a word with at least
1/ITEM_SHARE of all tokens is an item of its own, the others are items by their last
letters. From there every training word is placed by itself, on Spark: each round counts
the classes before and after half of the words, which go to their best class against the
class table of the round's start, so two rounds place every word once. Words that training
does not have go by their last letters. A text's probability is the product over its tokens of the class transition and
of the word's emission from its class, both smoothed; the class chain starts from the end
token's class.

Texts are encoded block by block: a block lists its different words once, so counts
travel per block and word, not per document and word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.session import last_read, release, settle
from .common import remainder, slices, utf8
from .wordhash import LOWER, find_words, hash_spans

FOLDS, HELD_OUT = 7, 2
BLOCK_BYTES = 6 << 20
ITEM_SHARE = 2048
"""Every item of the start but the rest has 1/2048 of all tokens or more, so there are at most 2049, and 2049 ** 2 pairs."""
CLASSES = 48
ROUNDS = 6
PLACING = 2
"""Rounds on Spark. More of them raise the mutual information of the training texts, not the probability of others (README)."""
FAN = 256
"""Counts of a word from more blocks than this are summed in several steps, so that no row gathers more parts."""
PRIOR = 50.0
"""Tokens that a class's share of the corpus counts for among its transitions."""
END, REST = 0, 1
SETTLED = 1e-3
"""Rounds end when two in succession raise the mutual information by less than this share of it."""


def _squeeze(codes: np.ndarray) -> bytes:
    """Codes as four planes of bytes, packed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unsqueeze(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


_BLOCK = "block long, ids array<long>, held array<boolean>, sizes array<int>, codes binary, words array<string>, counts array<long>"
_BLOCK_ARROW = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())), ("codes", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


class _Block:
    """Texts of one block: words by their hash, so two words of a block that share all 64 bits would count as one."""

    def __init__(self):
        self.ids, self.held, self.sizes, self.hashes, self.bytes = [], [], [], [], 0
        self.words: list[np.ndarray] = []
        self.names: list[list[bytes]] = []

    def add(self, ids: list, held: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, first = find_words(data, offsets)
        hashes = hash_spans(data, starts, ends)
        unique, at = np.unique(hashes, return_index=True)
        lowered = LOWER[data].tobytes()
        self.words.append(unique)
        self.names.append([lowered[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        self.hashes.append(hashes)
        self.ids += ids
        self.held.append(held)
        self.sizes.append(np.diff(first))
        self.bytes += len(data)

    def close(self, number: int) -> pa.RecordBatch:
        hashes, sizes, held = np.concatenate(self.hashes), np.concatenate(self.sizes), np.concatenate(self.held)
        words, at = np.unique(np.concatenate(self.words), return_index=True)
        names = [n for part in self.names for n in part]
        code = np.searchsorted(words, hashes)
        order = np.argsort(-np.bincount(code, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        code = rank[code]
        counts = np.bincount(code[np.repeat(~held, sizes)], minlength=len(words))
        row = [number, self.ids, held.tolist(), sizes.astype(np.int32), _squeeze(code), [names[at[k]].decode("utf-8", "replace") for k in order.tolist()], counts]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK_ARROW)], schema=_BLOCK_ARROW)


def encode(docs: DataFrame, doc_id: str, text: str, fold: tuple[int, int], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of texts: ids, folds, sizes, codes of all words in order, the words and their training counts."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            ids, held = batch.column("id").to_pylist(), np.array(batch.column("held").to_pylist(), bool)
            for begin, end, data, offsets in slices(batch.column("body")):
                block.add(ids[begin:end], held[begin:end], data, offsets)
                if block.bytes > block_bytes:
                    yield block.close(number)
                    number, block = number + 1, _Block()
        if block.ids:
            yield block.close(number)
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), (remainder(F.col(doc_id), fold[0]) == fold[1]).alias("held"), utf8(F.col(text)).alias("body"))
    return rows.mapInArrow(build, _BLOCK)


def g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def information(table: np.ndarray) -> float:
    """What an assignment is judged by: the mutual information of neighbouring classes, times tokens, plus a constant."""
    return float(g(table).sum() - g(table.sum(0)).sum() - g(table.sum(1)).sum())


def best_classes(of: np.ndarray, slots: np.ndarray, n: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class of each word that raises ``information`` most if that word alone moves.

    Entries (of, slot, n) tell how often word number ``of`` stands before class ``slot``
    (below k), after class ``slot - k`` (below 2k), or before itself (2k; these are among the others too).
    """
    k, w = len(table), len(own)
    at = np.arange(w)

    def counts(lo: int, hi: int) -> np.ndarray:
        mine = (slots >= lo) & (slots < hi)
        return np.bincount(of[mine] * (hi - lo) + slots[mine] - lo, n[mine], w * (hi - lo)).reshape(w, hi - lo)

    right, left, self_ = counts(0, k), counts(k, 2 * k), counts(2 * k, 2 * k + 1)[:, 0]
    right[at, own] -= self_
    left[at, own] -= self_

    def side(here: np.ndarray, other: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Gain per class but for its cell with itself; ``cells[r]`` are its cells with class r, the word still in them."""
        word, r = np.nonzero(here)
        number, rows = here[word, r], np.arange(len(word))
        x = cells[r]
        x[rows, own[word]] -= number
        mine = np.flatnonzero(r == own[word])
        x[mine] -= other[word[mine]]
        change = g(x + number[:, None]) - g(x)
        change[rows, r] = 0
        out = np.zeros((w, k))
        some, first = np.unique(word, return_index=True)
        if len(some):
            out[some] = np.add.reduceat(change, first, axis=0)
        return out

    gain = side(right, left, table.T.copy()) + side(left, right, table.copy())
    diagonal = np.repeat(np.diag(table)[None], w, 0)
    diagonal[at, own] -= right[at, own] + left[at, own] + self_
    gain += g(diagonal + right + left + self_[:, None]) - g(diagonal)
    for sums, tokens in ((table.sum(1), right.sum(1) + self_), (table.sum(0), left.sum(1) + self_)):
        others = np.repeat(sums[None], w, 0)
        others[at, own] -= tokens
        gain -= g(others + tokens[:, None]) - g(others)
    gain[:, END] = -np.inf
    best = gain.argmax(1)
    return np.where(gain[at, best] > gain[at, own] + 1e-9, best, own)


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each item from the counts of neighbouring items (first, second).

    Starts with items dealt out by frequency and moves one item at a time to the class
    that raises the mutual information of neighbouring classes most. The end token has
    class 0 to itself.
    """
    m = len(pairs)
    size = pairs.sum(0) + pairs.sum(1)
    order = np.argsort(-size, kind="stable")
    order = order[order != END]
    k = max(2, min(classes, m))
    of = np.zeros(m, np.int64)
    of[order] = 1 + np.arange(len(order)) % (k - 1)
    member = np.zeros((m, k))
    member[np.arange(m), of] = 1
    table = member.T @ pairs @ member

    for _ in range(rounds):
        moved = 0
        for w in order.tolist():
            own, self_ = of[w], pairs[w, w]
            member[w, own] = 0
            right, left = pairs[w] @ member, pairs[:, w] @ member
            table[own] -= right
            table[:, own] -= left
            table[own, own] -= self_
            rows, cols = table.sum(1), table.sum(0)
            diagonal = np.diag(table)
            gain = (g(table + right) - g(table)).sum(1) - (g(diagonal + right) - g(diagonal))
            gain += (g(table + left[:, None]) - g(table)).sum(0) - (g(diagonal + left) - g(diagonal))
            gain += g(diagonal + right + left + self_) - g(diagonal)
            gain -= g(rows + right.sum() + self_) - g(rows) + g(cols + left.sum() + self_) - g(cols)
            gain[END] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[own] + 1e-9:
                best = own
            moved += best != own
            of[w] = best
            member[w, best] = 1
            table[best] += right
            table[:, best] += left
            table[best, best] += self_
        if not moved:
            break
    return of


@dataclass
class Model:
    """log10 of class transitions, and of each item's class size plus its words plus one."""

    of: np.ndarray
    transitions: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def fit(pairs: np.ndarray, tokens: np.ndarray, words: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS, prior: float = PRIOR) -> Model:
        """``tokens`` and ``words`` count an item's tokens and different words in training."""
        of = exchange(pairs, classes, rounds)
        member = np.zeros((len(of), int(of.max()) + 1))
        member[np.arange(len(of)), of] = 1
        return Model.smooth(of, member.T @ pairs @ member, tokens @ member, words @ member, prior)

    @staticmethod
    def smooth(of: np.ndarray, table: np.ndarray, total: np.ndarray, different: np.ndarray, prior: float = PRIOR) -> Model:
        """From the counts of neighbouring classes, and each class's tokens and different words."""
        share = (total + 1) / (total.sum() + len(table))
        smoothed = (table + prior * share) / (table.sum(1, keepdims=True) + prior)
        return Model(of, np.log10(smoothed), np.log10(total + different + 1))

    def score(self, items: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sum over each text's tokens of log10 transition less log10 class size; texts end with END."""
        of = self.of[items]
        before = np.concatenate([[self.of[END]], of[:-1]])
        each = self.transitions[before, of] - self.sizes[of]
        sums = np.concatenate([[0.0], np.cumsum(each)])
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]


def _answered(blocks: DataFrame, found: DataFrame, *columns: str) -> DataFrame:
    """Blocks with ``columns`` of their words, from the rows of ``found``."""
    answers = found.groupBy("block").agg(F.collect_list(F.struct("code", *columns)).alias("answers"))
    return blocks.select("block", "ids", "held", "sizes", "codes").join(answers, "block", "left")


def _read(batches: Iterator[pa.RecordBatch], *columns: str, first: str = "block") -> Iterator[tuple]:
    """Per block its number (or other ``first`` column), folds, sizes, codes, and the words' ``columns`` by code, 0 for words without an answer."""
    for batch in batches:
        for row in range(batch.num_rows):
            ids, held, sizes = (batch.column(c)[row].as_py() for c in (first, "held", "sizes"))
            answers = batch.column("answers")[row].values
            at = answers.field("code").to_numpy() if answers is not None else np.zeros(0, np.int64)
            by_code = [np.zeros(int(at.max(initial=-1)) + 1, np.int64) for _ in columns]
            for values, c in zip(by_code, columns):
                if len(at):
                    values[at] = answers.field(c).to_numpy()
            yield ids, np.array(held, bool), np.array(sizes, np.int64), _unsqueeze(batch.column("codes")[row].as_py()).astype(np.int64), by_code
    pa.default_memory_pool().release_unused()  # idle workers stay, and would hold it through later stages


def _training(codes: np.ndarray, held: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the training texts, -1 after each text, and before the first."""
    train = ~held
    kept = codes[np.repeat(train, sizes)]
    return np.concatenate([[-1], np.insert(kept, np.cumsum(sizes[train]), -1)]), train


def _pairs(blocks: DataFrame, found: DataFrame, m: int) -> np.ndarray:
    """Counts of neighbouring items over all training texts, summed per block before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, sizes, codes, (item,) in _read(batches, "item"):
            series, _ = _training(codes, held, sizes)
            items = np.append(item, END)[series]
            keys, n = np.unique(items[:-1] * m + items[1:], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])

    counted = _answered(blocks, found, "item").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    rows = last_read(counted)
    out = np.zeros(m * m)
    out[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(m, m)


_ENTRY = np.dtype([("slot", "u1"), ("n", "<u4")])


def _packed(slots: np.ndarray, n: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Entries (slot, n) of five bytes each, cut at ``ends``."""
    entries = np.empty(ends[-1] - ends[0], _ENTRY)
    entries["slot"], entries["n"] = slots[ends[0] : ends[-1]], n[ends[0] : ends[-1]]
    offsets = ((ends - ends[0]) * _ENTRY.itemsize).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(entries.tobytes())])


def _neighbours(blocks: DataFrame, found: DataFrame, k: int, n_blocks: int, half: int, fan: int = FAN) -> DataFrame:
    """id, own class and counts of the neighbouring classes of the training words with an even or odd digest (``half``).

    The counts are in at most about ``fan`` packed parts; see ``best_classes`` for slots.
    Rows without an id tell how often each class stands before each other one, over all words.
    """
    width = 2 * k + 1
    if width > 256:
        raise ValueError("a slot is one byte: at most 127 classes")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held, sizes, codes, (number, class_) in _read(batches, "id", "class"):
            series, _ = _training(codes, held, sizes)
            a, b = series[:-1], series[1:]
            of, moves = np.append(class_, END), np.append((number >> 7 & 1) == half, False)

            def rows(ids: pa.Array, own: np.ndarray, slots: np.ndarray, n: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([ids, pa.array(own.astype(np.int32)), pa.array(np.full(len(own), block)), _packed(slots, n, ends)], names=["id", "own", "part", "counts"])

            table = np.bincount(of[a] * k + of[b], minlength=k * k)
            pairs = np.flatnonzero(table)
            if not len(pairs):
                continue
            classes, first = np.unique(pairs // k, return_index=True)
            yield rows(pa.nulls(len(classes), pa.int64()), classes, pairs % k, table[pairs], np.append(first, len(pairs)))

            before, after = moves[a], moves[b]
            twice = before & (a == b)
            keys = np.concatenate([a[before] * width + of[b[before]], b[after] * width + k + of[a[after]], a[twice] * width + 2 * k])
            keys, n = np.unique(keys, return_counts=True)
            code, first = np.unique(keys // width, return_index=True)
            ends = np.append(first, len(keys))
            for lo in range(0, len(code), 20_000):
                part = code[lo : lo + 20_000]
                yield rows(pa.array(number[part]), class_[part], keys % width, n, ends[lo : lo + len(part) + 1])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, slots, n = _unpack(batch)
            keys, at = np.unique(of * width + slots, return_inverse=True)
            sums = np.bincount(at, n, len(keys)).astype(np.int64)
            times = -(-sums // _MOST)  # a sum beyond 32 bits is several entries
            keys, sums = np.repeat(keys, times), np.repeat(sums, times)
            again = np.arange(len(keys)) - np.repeat(np.cumsum(times) - times, times)
            sums = np.minimum(sums - again * _MOST, _MOST)
            ends = np.searchsorted(keys // width, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("own"), batch.column("part"), _packed(keys % width, sums, ends)], names=["id", "own", "part", "counts"])

    schema = "id long, own int, part long, counts binary"
    rows, parts = _answered(blocks, found, "id", "class").mapInArrow(count, schema), n_blocks
    while parts > fan:
        parts = -(-parts // fan)
        part = F.pmod(F.xxhash64("part", F.lit(parts)), F.lit(parts)).alias("part")
        rows = rows.groupBy("id", "own", part).agg(F.collect_list("counts").alias("counts")).mapInArrow(add, schema)
    return rows.groupBy("id", "own").agg(F.collect_list("counts").alias("counts"))


_MOST = 1 << 30


def _unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (row of the batch, slot, n) of a batch's packed counts."""
    column = batch.column("counts")
    packed = column.flatten()
    entries = np.frombuffer(b"".join(packed.to_pylist()), _ENTRY)
    parts = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy(zero_copy_only=False))
    sizes = pa.compute.binary_length(packed).to_numpy(zero_copy_only=False) // _ENTRY.itemsize
    return np.repeat(parts, sizes), entries["slot"].astype(np.int64), entries["n"].astype(float)


def _class_table(near: DataFrame, k: int) -> np.ndarray:
    """Counts of neighbouring classes, from the rows without an id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k * k)
        for batch in batches:
            of, slots, n = _unpack(batch)
            sums += np.bincount(batch.column("own").to_numpy().astype(np.int64)[of] * k + slots, n, k * k)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some].astype(np.int64))], names=["pair", "n"])

    rows = last_read(near.filter("id is null").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    out = np.zeros(k * k)
    out[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(k, k)


def _placed(found: DataFrame, near: DataFrame, table: np.ndarray) -> DataFrame:
    """The words of ``found``, those that ``near`` tells the neighbours of in their best class."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                batch = whole.slice(lo, 2000)
                best = best_classes(*_unpack(batch), batch.column("own").to_numpy().astype(np.int64), table)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(best.astype(np.int32))], names=["id", "placed"])

    moved = near.filter("id is not null").mapInArrow(choose, "id long, placed int")
    return found.join(moved, "id", "left").withColumn("class", F.coalesce("placed", "class")).drop("placed")


def cluster(blocks: DataFrame, start: DataFrame, k: int, rounds: int, n_blocks: int, fan: int = FAN) -> tuple[DataFrame, np.ndarray]:
    """The words with the class of each, and the counts of neighbouring classes under it.

    ``start`` has the words with the class they start from, settled; words without
    training tokens keep it. Halves of the words move in turn; the assignment with the
    highest mutual information is returned, settled. What else is settled, ``start``
    too, is deleted once it is read.
    """
    found, best, gains = start, None, []
    for number in range(rounds + 1):
        near = None
        if number < rounds:
            near = settle(_neighbours(blocks, found.filter("c > 0"), k, n_blocks, number % 2, fan))
            table = _class_table(near, k)
        else:
            table = _pairs(blocks, found.filter("c > 0").select("block", "code", F.col("class").alias("item")), k)
        value = information(table)
        gains.append(np.inf if best is None else value - best[0])
        if best is None or value > best[0]:
            if best:
                release(best[1])
            best = (value, found, table)
        spread = abs(value - information(np.outer(table.sum(1), table.sum(0)) / max(1, table.sum())))
        ended = number == rounds or max(gains[-2:]) < SETTLED * spread
        following = None if ended else settle(_placed(found, near, table))
        if near:
            release(near)
        if found is not best[1]:
            release(found)
        if ended:
            break
        found = following
    return best[1], best[2]


_AT_ONCE = 200_000
"""Words that a task scores at once, or one text."""
_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double"
_SCORED_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("log_counts", pa.float64()), ("score", pa.float64())])


def _score(blocks: DataFrame, found: DataFrame, ends: int, model: Model) -> DataFrame:
    """Per text its tokens, known tokens, sum of log10(count + 1) and score; ``ends`` counts the end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held, sizes, codes, (count, class_) in _read(batches, "c", "class", first="ids"):
            logs, known, ends_at, lo = np.log10(count + 1), (count > 0).astype(np.int64), np.cumsum(sizes), 0
            while lo < len(ids):
                start = ends_at[lo] - sizes[lo]
                hi = min(max(lo + 1, int(np.searchsorted(ends_at, start + _AT_ONCE, side="right"))), lo + 2000)
                size, part = sizes[lo:hi], codes[start : ends_at[hi - 1]]
                b = np.cumsum(size)

                def sums(values: np.ndarray) -> np.ndarray:
                    so_far = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
                    return so_far[b] - so_far[b - size]

                given = sums(logs[part]) + np.log10(ends + 1)
                score = model.score(np.insert(class_[part], b, END), size + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi], pa.int64()), pa.array(held[lo:hi], pa.bool_()), pa.array(size + 1), pa.array(sums(known[part]) + (ends > 0)), pa.array(given), pa.array(given + score)],
                    schema=_SCORED_ARROW,
                )
                lo = hi

    return _answered(blocks, found, "c", "class").mapInArrow(run, _SCORED)


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fold: tuple[int, int] = (FOLDS, HELD_OUT), classes: int = CLASSES, rounds: int = ROUNDS, item_share: int = ITEM_SHARE, block_bytes: int = BLOCK_BYTES, placing: int = PLACING, fan: int = FAN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity per row of ``docs``.

    Words are cut at white space and A-Z lower-cased; one end follows each text and is
    all of an empty or null one. The model learns from the rows outside the held-out
    fold, and clusters every word of theirs; repeated rows count as often as they occur. Without training rows every word is
    unknown. An empty table gives an empty result.
    """
    blocks = settle(encode(docs, doc_id, text, fold, block_bytes))
    training = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    texts_in = F.size(F.filter("held", lambda h: ~h))
    sums = blocks.agg(F.sum(training).alias("words"), F.sum(texts_in).alias("texts"), F.count("*").alias("blocks")).first()
    ends = sums.texts or 0
    total = (sums.words or 0) + ends
    listed = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w")).select("block", "code", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    # a word has one row per block at most, out of the block's hundred thousand words
    same = Window.partitionBy("word")
    counted = listed.withColumns({"c": F.sum("n").over(same), "first": F.col("block") == F.min("block").over(same)})
    shape = F.concat(F.lit(" "), F.substring("word", -2, 2))
    key = F.when((F.col("c") > 0) & (F.col("c") * item_share >= total), F.col("word")).otherwise(shape)
    words = settle(counted.select("block", "code", F.xxhash64("word").alias("id"), "c", "first", key.alias("key")))

    lean = settle(blocks.select("block", "ids", "held", "sizes", "codes"))
    release(blocks)
    blocks = lean
    kept = words.filter("first and c > 0").groupBy("key").agg(F.sum("c").alias("tokens"), F.count("*").alias("words"))
    kept = settle(kept)
    items = kept.filter(F.col("tokens") * item_share >= total).orderBy("key").collect()
    others = kept.filter(F.col("tokens") * item_share < total).agg(F.sum("tokens"), F.sum("words")).first()
    number = docs.sparkSession.createDataFrame([(r.key, k + 2) for k, r in enumerate(items)], "key string, item int")
    tokens = np.array([ends, others[0] or 0, *(r.tokens for r in items)], float)
    different = np.array([min(ends, 1), others[1] or 0, *(r.words for r in items)], float)
    vocabulary = int(different.sum())

    of = exchange(_pairs(blocks, words.filter("c > 0").join(F.broadcast(number), "key", "left").select("block", "code", F.coalesce("item", F.lit(REST)).alias("item")), len(tokens)), classes, rounds)
    k = int(of.max()) + 1
    begun = docs.sparkSession.createDataFrame([(r.key, int(of[i + 2])) for i, r in enumerate(items)], "key string, class int")
    start = settle(words.join(F.broadcast(begun), "key", "left").select("block", "code", "id", "c", "first", F.coalesce("class", F.lit(int(of[REST]))).alias("class")))
    release(words)
    found, table = cluster(blocks, start, k, placing, sums.blocks, fan)
    total_of, different_of = np.zeros(k), np.zeros(k)
    for r in found.filter("first and c > 0").groupBy("class").agg(F.sum("c").alias("tokens"), F.count("*").alias("words")).collect():
        total_of[r["class"]], different_of[r["class"]] = r.tokens, r.words
    total_of[END], different_of[END] = ends, min(ends, 1)
    scored = _score(blocks, found, ends, Model.smooth(np.arange(k), table, total_of, different_of))
    base = F.col("log_counts") - F.col("n_tokens") * F.lit(float(np.log10(total + vocabulary + 1)))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
