"""Aligning the tokens of two tokenizers over the bytes of each text.

Each text is encoded by A, a byte-level BPE, and by B, a piece BPE. Two dictionaries lead
from the byte offset at which a token ends to the token's index; the offsets that both
have, sorted, cut both id lists into groups, and every A token of a group is linked with
every B token of it. How many documents hold a pair of ids linked is counted over the whole
corpus.

Texts are encoded block by block: a block lists its different pairs once, so counts travel
per block and pair, and each document keeps its pairs as codes into its block's list.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.session import settle
from .common import answer, slices, utf8

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 6 << 20
BLOCK_PAIRS = 4_000_000
"""A block ends at so many pairs of its documents too."""
LINKS = 1 << 21
"""Links expanded at once."""
LONG_RUN = 4000
"""Texts with a longer run of white space, or of anything else, go to the tokenizer whose merges do not take the square of a run's length."""
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
"""Fixed value: the published pattern that byte-level BPE splits a text by before its merges."""


def byte_letters() -> dict[str, int]:
    """The letter that byte-level BPE writes for each byte: printable bytes for themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """The byte-level BPE of a ``tokenizers`` file.

    Where merges are in the order of ids, the same ids come faster from ``tiktoken``
    over the file's own vocabulary; special tokens are plain text either way.
    """

    def __init__(self, file: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(file)
        self.slow.encode_special_tokens = True
        with open(file, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, vocabulary = byte_letters(), model["vocab"]
        self.bytes = [b""] * (max(max(vocabulary.values()), self.slow.get_vocab_size() - 1) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
        self.fast = None
        if merged == sorted(merged):
            special = {t.content for t in self.slow.get_added_tokens_decoder().values()}
            ranks = {self.bytes[n]: n for t, n in vocabulary.items() if t not in special}
            self.fast = tiktoken.Encoding("byte level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is None or len(text) > LONG_RUN and (max(map(len, text.split()), default=0) > LONG_RUN or re.search(r"\s{%d}" % LONG_RUN, text)):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """The piece BPE of a ``sentencepiece`` file."""

    def __init__(self, file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=file)
        n = self.model.vocab_size()
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(self.model.id_to_piece(list(range(n))))]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


@lru_cache(maxsize=4)
def load(kind: type, file: str) -> tuple:
    """A tokenizer, its tokens' lengths in bytes, and its ids spelled inside a group and as its last, once per worker."""
    tokenizer = kind(file)
    inside = np.array([f"{i}," for i in range(len(tokenizer.bytes))], object)
    last = np.array([f"{i}{'|' if kind is ByteLevel else ';'}" for i in range(len(tokenizer.bytes))], object)
    return tokenizer, np.array([len(b) for b in tokenizer.bytes], np.int64), (inside, last)


def encode_both(raw: bytes, a: ByteLevel, b: Pieces) -> tuple[list[int], list[int]]:
    """Ids by A and by B; none if the text is empty, not UTF-8, or not what the tokens' bytes join to."""
    if not raw:
        return [], []
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return [], []
    whole = b" " + raw
    ids_a, ids_b = a.encode(" " + text), b.encode(text)
    if b"".join(map(a.bytes.__getitem__, ids_a)) != whole or b"".join(map(b.bytes.__getitem__, ids_b)) != whole:
        return [], []
    return ids_a, ids_b


def cut_groups(ends_a: Sequence[int], ends_b: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each group the number of A tokens, and of B tokens, up to its end."""
    at_a, at_b = dict(zip(ends_a, range(1, len(ends_a) + 1))), dict(zip(ends_b, range(1, len(ends_b) + 1)))
    common = [end for end in at_a if end in at_b]  # in the order of A's tokens, so sorted
    n = len(common)
    return np.fromiter(map(at_a.__getitem__, common), np.int64, n), np.fromiter(map(at_b.__getitem__, common), np.int64, n)


def _pack(values: np.ndarray) -> bytes:
    """Integers as eight planes of bytes, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel()


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a << 32 | b


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    different, at = np.unique(keys, return_inverse=True)
    return different, np.bincount(at, n, len(different)).astype(np.int64)


def _expanded(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of ids and how often, some LINKS at a time."""
    from_a, from_b = np.concatenate([[0], cut_a[:-1]]), np.concatenate([[0], cut_b[:-1]])
    n_a, n_b = cut_a - from_a, cut_b - from_b
    links = n_a * n_b
    wide = links > LINKS
    some = np.flatnonzero(~wide)
    sums = np.cumsum(links[some])
    lo = 0
    while lo < len(some):
        hi = max(lo + 1, int(np.searchsorted(sums, (sums[lo - 1] if lo else 0) + LINKS, "right")))
        part = some[lo:hi]
        of = np.repeat(part, links[part])
        before = np.cumsum(links[part]) - links[part]
        place = np.arange(len(of)) - np.repeat(before, links[part])
        keys = _pair(a[from_a[of] + place // n_b[of]], b[from_b[of] + place % n_b[of]])
        yield np.unique(keys, return_counts=True)
        lo = hi
    for g in np.flatnonzero(wide).tolist():
        ids_a, count_a = np.unique(a[from_a[g] : cut_a[g]], return_counts=True)
        ids_b, count_b = np.unique(b[from_b[g] : cut_b[g]], return_counts=True)
        step = max(1, LINKS // len(ids_b))
        for lo in range(0, len(ids_a), step):
            part = slice(lo, lo + step)
            yield _pair(ids_a[part, None], ids_b[None]).ravel(), (count_a[part, None] * count_b[None]).ravel()


def link(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different linked pairs of a text, and the links of each."""
    parts = list(_expanded(a, b, cut_a, cut_b))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return parts[0] if len(parts) == 1 else _summed(*(np.concatenate(c) for c in zip(*parts)))


def spell_groups(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, spelled_a: tuple, spelled_b: tuple) -> str:
    """``a1,a2|b1;a3|b2,b3``: each token is put at its place, with the sign that follows it."""
    n_a, n_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    out = np.empty(len(a) + len(b), object)
    for ids, at, cut, (inside, last) in (
        (a, np.arange(len(a)) + np.repeat(cut_b - n_b, n_a), cut_a, spelled_a),
        (b, np.arange(len(b)) + np.repeat(cut_a, n_b), cut_b, spelled_b),
    ):
        text = inside[ids]
        text[cut - 1] = last[ids[cut - 1]]
        out[at] = text
    return "".join(out.tolist())[:-1]


_DOCUMENT = pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.int64())])
_BLOCK_ARROW = pa.schema([("block", pa.int64()), ("documents", pa.list_(_DOCUMENT)), ("codes", pa.binary()), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int64()))])
_BLOCK = "block long, documents array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string, pairs: long>>, codes binary, links binary, pairs array<long>, holders array<long>"


class _Block:
    def __init__(self):
        self.rows, self.keys, self.links, self.bytes, self.pairs = [], [], [], 0, 0

    def add(self, doc_id: int | None, raw: bytes, a: tuple, b: tuple) -> None:
        (tok_a, len_a, text_a), (tok_b, len_b, text_b) = a, b
        ids_a, ids_b = encode_both(raw, tok_a, tok_b)
        self.bytes += len(raw)
        row = {"doc_id": doc_id, "n_a": len(ids_a), "n_b": len(ids_b), "n_groups": 0, "n_links": 0, "groups_sha256": "", "pairs": 0}
        if ids_a:
            of_a, of_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
            cuts = cut_groups(np.cumsum(len_a[of_a]).tolist(), np.cumsum(len_b[of_b]).tolist())
            keys, links = link(of_a, of_b, *cuts)
            spelled = spell_groups(of_a, of_b, *cuts, text_a, text_b)
            row |= {"n_groups": len(cuts[0]), "n_links": int(links.sum()), "groups_sha256": hashlib.sha256(spelled.encode()).hexdigest(), "pairs": len(keys)}
            self.keys.append(keys)
            self.links.append(links)
            self.pairs += len(keys)
        self.rows.append(row)

    def close(self, number: int) -> pa.RecordBatch:
        keys = np.concatenate([np.zeros(0, np.int64), *self.keys])
        links = np.concatenate([np.zeros(0, np.int64), *self.links])
        pairs, code, holders = np.unique(keys, return_inverse=True, return_counts=True)
        order = np.argsort(-holders, kind="stable")
        rank = np.empty(len(pairs), np.int64)
        rank[order] = np.arange(len(pairs))
        row = [number, self.rows, _pack(rank[code]), _pack(links), pairs[order], holders[order]]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK_ARROW)], schema=_BLOCK_ARROW)


def encode(docs: DataFrame, doc_id: str, text: str, a_file: str, b_file: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block: its documents, their pairs as codes with links, its different pairs and how many of its documents hold each."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = load(ByteLevel, a_file), load(Pieces, b_file)
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for key, body in zip(batch.column("id").to_pylist(), chain.from_iterable(_bodies(batch))):
                block.add(key, body, a, b)
                if block.bytes > block_bytes or block.pairs > BLOCK_PAIRS:
                    yield block.close(number)
                    number, block = number + 1, _Block()
        if block.rows:
            yield block.close(number)

    return docs.select(F.col(doc_id).cast("long").alias("id"), utf8(F.col(text)).alias("body")).mapInArrow(build, _BLOCK)


def _bodies(batch: pa.RecordBatch) -> Iterator[list[bytes]]:
    for _, _, data, offsets in slices(batch.column("body")):
        raw, cuts = data.tobytes(), offsets.tolist()
        yield [raw[i:j] for i, j in zip(cuts, cuts[1:])]


def count_pairs(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, code, pair) for each pair of a block, and per pair its blocks, count of documents, and whether that is its A id's highest."""
    listed = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("code", "p")).select("block", "code", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("holders"))
    counts = settle(listed.groupBy("pair").agg(F.sum("holders").alias("count"), F.count("*").alias("blocks")))
    of_a = F.shiftright("pair", 32)
    highest = counts.groupBy(of_a.alias("a")).agg(F.max("count").alias("highest"))
    # one row per id of A's vocabulary at most
    marked = counts.withColumn("a", of_a).join(F.broadcast(highest), "a").select("pair", "blocks", "count", (F.col("count") == F.col("highest")).alias("best"))
    return listed.drop("holders"), marked


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_ALIGNED_ARROW = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", pa.string())])


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            documents, answers = batch.column("documents")[row].values, batch.column("answers")[row].values
            code, links = (_unpack(batch.column(c)[row].as_py()) for c in ("codes", "links"))
            n = len(answers) if answers is not None else 0
            count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
            if n:
                at = answers.field("code").to_numpy()
                count[at] = answers.field("count").to_numpy()
                best[at] = answers.field("best").to_numpy(zero_copy_only=False)
            ends = np.cumsum(documents.field("pairs").to_numpy())
            sums = [np.concatenate([[0], np.cumsum(links * v[code])]) for v in (best, count)]
            n_best, count_sum = (s[ends] - s[np.concatenate([[0], ends[:-1]])] for s in sums)
            plain = {n: documents.field(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            columns = plain | {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in _ALIGNED_ARROW], schema=_ALIGNED_ARROW)


def align_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS, a_file: str = A_FILE, b_file: str = B_FILE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row its tokens by A and B, groups, links, links to the best partner, and the links' counts summed.

    ``tokenizers`` is a folder that every executor has. A null or empty text, and one that
    the tokens' bytes do not give back, has no tokens: zeros and an empty digest. Repeated
    rows are documents of their own and count as such. An empty table gives an empty result.
    A text of one unbroken run keeps a pair for each two different ids of a group, which is
    what the counts need; it is the only case in which a task's memory exceeds a small
    multiple of its texts.
    """
    blocks = settle(encode(docs, doc_id, text, f"{tokenizers}/{a_file}", f"{tokenizers}/{b_file}", block_bytes))
    listed, marked = count_pairs(blocks)
    marked = settle(marked)
    total = marked.agg(F.sum("blocks")).first()[0] or 0
    found = answer(listed, marked, ["pair"], ["count", "best"], "blocks", total)
    answers = found.groupBy("block").agg(F.collect_list(F.struct("code", "count", "best")).alias("answers"))
    return blocks.select("block", "documents", "codes", "links").join(answers, "block", "left").mapInArrow(_per_document, _ALIGNED)


def linked_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS, a_file: str = A_FILE, b_file: str = B_FILE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The table of correspondences itself: id of A, id of B, count of documents, and whether it is the A id's highest."""
    blocks = settle(encode(docs, doc_id, text, f"{tokenizers}/{a_file}", f"{tokenizers}/{b_file}", block_bytes))
    _, marked = count_pairs(blocks)
    return marked.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "count", "best")
