"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on words of labelled
documents and labels every byte position of a text; a document's probabilities are the
mean over its letters' positions. Its state starts anew at each word, with a space on
either side, so equal words get equal labels and a task evaluates each word once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.session import settle
from .common import remainder, slices, utf8, without
from .wordhash import LOWER, find_words, hash_spans

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
SAMPLE_DOCS = 4_000
"""Labelled documents the training words are taken from: those with the smallest hash, per language."""
SAMPLE_WORDS = 6_000
"""Training words per language, those with the smallest hash."""
HIDDEN, EPOCHS, BATCH, RATE = 16, 3, 128, 0.01
PIECE = 32
"""Longer words are cut into pieces of this many bytes."""
CACHE = 500_000
"""Words whose labels a task remembers before it starts over."""
_SPACE = 32
_DRAWS = 1 << 20
IS_LETTER = np.array([c >= 0x80 or 65 <= c <= 90 or 97 <= c <= 122 for c in range(256)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Direction:
    """One gated recurrent layer: input table, recurrent weights, gates in the order update, reset, new."""

    table: np.ndarray
    weights: np.ndarray

    @staticmethod
    def fresh(rng: np.random.Generator, hidden: int) -> Direction:
        return Direction(rng.normal(0, 0.1, (256, 3 * hidden)).astype(np.float32), rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32))

    def forward(self, x: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (steps, rows, hidden) after each byte of x (rows, steps)."""
        n = self.weights.shape[0]
        h = np.zeros((len(x), n), np.float32)
        out = np.empty((x.shape[1], len(x), n), np.float32)
        for t in range(x.shape[1]):
            given, kept = self.table[x[:, t]], h @ self.weights
            gates = _sigmoid(given[:, : 2 * n] + kept[:, : 2 * n])
            z, r = gates[:, :n], gates[:, n:]
            new = np.tanh(given[:, 2 * n :] + r * kept[:, 2 * n :])
            if trace is not None:
                trace.append((x[:, t], h, z, r, new, kept[:, 2 * n :]))
            h = new + z * (h - new)
            out[t] = h
        return out

    def backward(self, trace: list, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and weights, given those of the states."""
        n = self.weights.shape[0]
        d_weights, given = np.zeros_like(self.weights), []
        d_h = np.zeros(upper.shape[1:], np.float32)
        for t in range(len(trace) - 1, -1, -1):
            x, before, z, r, new, kept = trace[t]
            d_h = d_h + upper[t]
            d_new = d_h * (1 - z) * (1 - new * new)
            d_z = d_h * (before - new) * z * (1 - z)
            d_r = d_new * kept * r * (1 - r)
            d_given = np.concatenate([d_z, d_r, d_new], axis=1)
            d_kept = np.concatenate([d_z, d_r, d_new * r], axis=1)
            given.append(d_given)
            d_weights += before.T @ d_kept
            d_h = d_h * z + d_kept @ self.weights.T
        seen = np.concatenate([step[0] for step in reversed(trace)])[:, None] == np.arange(256)
        return seen.astype(np.float32).T @ np.concatenate(given), d_weights


class Network:
    """Forward and backward layers and a softmax over languages at every position."""

    def __init__(self, languages: Sequence[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = list(languages)
        self.ahead, self.back = Direction.fresh(rng, hidden), Direction.fresh(rng, hidden)
        self.out = rng.normal(0, 0.1, (2 * hidden, len(self.languages))).astype(np.float32)
        self.bias = np.zeros(len(self.languages), np.float32)

    def _parameters(self) -> list[np.ndarray]:
        return [self.ahead.table, self.ahead.weights, self.back.table, self.back.weights, self.out, self.bias]

    def labels(self, x: np.ndarray, traces: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities (steps, rows, languages) at every position of x (rows, steps), and the states."""
        fore, aft = traces or (None, None)
        states = np.concatenate([self.ahead.forward(x, fore), self.back.forward(x[:, ::-1], aft)[::-1]], axis=2)
        logits = states @ self.out + self.bias
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        return e / e.sum(axis=2, keepdims=True), states

    def train(self, words: list[bytes], targets: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 11) -> None:
        """Cross-entropy at every position, batches of words of one length, Adam."""
        rng = np.random.default_rng(seed)
        lengths = np.array([len(w) for w in words])
        first = [np.zeros_like(p) for p in self._parameters()]
        second = [np.zeros_like(p) for p in self._parameters()]
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(words))
            order = order[np.argsort(lengths[order], kind="stable")]
            cuts = np.flatnonzero(np.diff(lengths[order])) + 1
            batches = [g[i : i + batch] for g in np.split(order, cuts) for i in range(0, len(g), batch)]
            for k in rng.permutation(len(batches)):
                rows = batches[k]
                x = framed(np.frombuffer(b"".join(words[i] for i in rows), np.uint8).reshape(len(rows), -1))
                traces: tuple[list, list] = ([], [])
                p, states = self.labels(x, traces)
                d = p / p.shape[0] / p.shape[1]
                d[:, np.arange(len(rows)), targets[rows]] -= 1 / p.shape[0] / p.shape[1]
                d_states = d @ self.out.T
                n = d_states.shape[2] // 2
                grads = [*self.ahead.backward(traces[0], d_states[:, :, :n]), *self.back.backward(traces[1], d_states[::-1, :, n:]), np.einsum("tbs,tbl->sl", states, d), d.sum((0, 1))]
                step += 1
                pace = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for w, g, m, v in zip(self._parameters(), grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= (pace * m / (np.sqrt(v) + 1e-8)).astype(np.float32)

    def pooled(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each word the probabilities summed over its letters, and the number of letters, in the last column."""
        out = np.zeros((len(starts), len(self.languages) + 1), np.float32)
        pieces = np.maximum(1, -(-(ends - starts) // PIECE))
        of = np.repeat(np.arange(len(starts)), pieces)
        begin = starts[of] + PIECE * (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        size = np.minimum(ends[of] - begin, PIECE)
        for length in np.unique(size):
            same = np.flatnonzero(size == length)
            for i in range(0, len(same), 2048):
                rows = same[i : i + 2048]
                raw = data[begin[rows][:, None] + np.arange(length)]
                letters = IS_LETTER[raw].astype(np.float32)
                p, _ = self.labels(framed(LOWER[raw]))
                np.add.at(out, of[rows], np.concatenate([np.einsum("tbl,bt->bl", p[1:-1], letters), letters.sum(1, keepdims=True)], axis=1))
        return out


def framed(x: np.ndarray) -> np.ndarray:
    """A space before and after each row."""
    edge = np.full((len(x), 1), _SPACE, np.uint8)
    return np.concatenate([edge, x, edge], axis=1)


def training_words(docs: DataFrame, doc_id: str, text: str, lang: str, sample_docs: int, sample_words: int, fold: tuple[int, int]) -> list[tuple[str, str]]:
    """A bounded sample of (language, word) from labelled documents outside the held-out fold.

    Documents are drawn by hash at twice the wanted rate before the exact first ones are
    taken, so no task ranks a whole language. There is one count per language.
    """
    labelled = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & (remainder(F.col(doc_id), fold[0]) != fold[1])).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id).cast("string")).alias("at")
    )
    slim = labelled.select("lang", "at", F.xxhash64("text").alias("body"))
    counts = slim.groupBy("lang").agg(F.count("*").alias("n"))
    drawn = slim.join(F.broadcast(counts), "lang").filter(F.pmod("at", F.lit(_DRAWS)) * F.col("n") < 2 * sample_docs * _DRAWS)
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("at", F.lit(_DRAWS)), "at", "body"))
    ids = drawn.withColumn("place", first).filter(F.col("place") <= sample_docs).select("lang", "at", "body").distinct()
    chosen = labelled.withColumn("body", F.xxhash64("text")).join(F.broadcast(ids), ["lang", "at", "body"], "left_semi")
    words = chosen.select("lang", F.posexplode(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("place", "word"), "at").filter("word <> ''")
    ranked = words.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("word", "at", "place"), "word")))
    return sorted((r.lang, r.word) for r in ranked.filter(F.col("rank") <= sample_words).select("lang", "word").collect())


def train_network(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS, fold: tuple[int, int] = (FOLDS, HELD_OUT)) -> Network | None:
    """A network for the languages of the labelled documents, None if there are none."""
    rows = training_words(docs, doc_id, text, lang, sample_docs, sample_words, fold)
    pairs = [(lang_, w) for lang_, word in rows if IS_LETTER[np.frombuffer((w := word.encode()[:PIECE]), np.uint8)].any()]
    if not pairs:
        return None
    network = Network(sorted({p[0] for p in pairs}))
    place = {name: i for i, name in enumerate(network.languages)}
    network.train([w for _, w in pairs], np.array([place[name] for name, _ in pairs]))
    return network


class _Reader:
    """Pooled labels of words, each evaluated once while it is remembered."""

    def __init__(self, network: Network):
        self.network = network
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros((0, len(network.languages) + 1), np.float32)

    def read(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts, ends, first = find_words(data, offsets)
        unique, at, back = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > CACHE:
            self.keys, self.values = self.keys[:0], self.values[:0]
        slot = np.minimum(np.searchsorted(self.keys, unique), max(0, len(self.keys) - 1))
        known = self.keys[slot] == unique if len(self.keys) else np.zeros(len(unique), bool)
        pooled = np.empty((len(unique), self.values.shape[1]), np.float32)
        pooled[known] = self.values[slot[known]]
        pooled[~known] = self.network.pooled(data, starts[at[~known]], ends[at[~known]])
        keys = np.concatenate([self.keys, unique[~known]])
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], np.concatenate([self.values, pooled[~known]])[order]
        sums = np.zeros((len(starts) + 1, pooled.shape[1]))
        np.cumsum(pooled[back], axis=0, out=sums[1:])
        return sums[first[1:]] - sums[first[:-1]]


def _has_letter(text: bytes) -> bool:
    if any(65 <= c <= 90 or 97 <= c <= 122 for c in text[:64]):
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


_COLUMNS = "doc_id long, h long, held_out boolean, lang_pred string, score double"
_ARROW = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def identify(docs: DataFrame, network: Network | None, doc_id: str = "doc_id", text: str = "text", fold: tuple[int, int] = (FOLDS, HELD_OUT)) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``; whole texts are read.

    Null text, text without a letter and everything when there is no network get
    ``und`` and score 0. Ties go to the language that sorts first. Rows are independent:
    repeated rows repeat, an empty table gives an empty result, other columns are ignored.
    """
    return _identify(docs, network, doc_id, text, fold).drop("h")


def _identify(docs: DataFrame, network: Network | None, doc_id: str = "doc_id", text: str = "text", fold: tuple[int, int] = (FOLDS, HELD_OUT)) -> DataFrame:
    """What ``identify`` gives, and the digest h of the text."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(network) if network else None
        for batch in batches:
            names, scores = [], []
            bodies = batch.column("body")
            for begin, end, data, offsets in slices(bodies, 4 << 20):
                if reader is None:
                    names += [UNKNOWN] * (end - begin)
                    scores += [0.0] * (end - begin)
                    continue
                pooled = reader.read(data, offsets)
                for k in range(end - begin):
                    letters = pooled[k, -1]
                    if letters < 0.5 or not _has_letter(data[offsets[k] : offsets[k + 1]].tobytes()):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    best = int(np.argmax(pooled[k, :-1]))
                    names.append(reader.network.languages[best])
                    scores.append(float(min(1.0, pooled[k, best] / letters)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema=_ARROW)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (remainder(F.col(doc_id), fold[0]) == fold[1]).alias("held_out"), utf8(F.col(text)).alias("body")).withColumn("h", F.xxhash64("body"))
    return rows.mapInArrow(predict, _COLUMNS)


def keep_identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose language is ``und``, by id and text; a null id is an id like others."""
    network = train_network(docs, doc_id, text, **options)
    found = _identify(docs, network, doc_id, text)
    rejected = settle(found.filter(F.col("lang_pred") == UNKNOWN).select("doc_id", "h").distinct())
    return without(docs, [F.col(doc_id).cast("long"), F.xxhash64(utf8(F.col(text)))], rejected)
