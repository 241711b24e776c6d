"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text's features are hashed counts of its words, of pairs and triples of words in a row, of the words' shapes (letters
to ``a`` and ``A``, digits to ``0``, runs shortened, other characters as they are), of pairs of shapes, and of whether a
word is the same again, divided by the number of n-grams.  Words of over ``WORD_CHARS`` characters count part by part, to their end.
Its score is the logistic function of the sparse dot product of counts and weights.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


#: Cells of the weight vector: 1 MB of 32-bit floats, whatever the input.
CELLS = 1 << 18
#: Labelled rows that the model learns from: those with the smallest hash of their id.
MAX_ROWS = 8_000
EPOCHS, ALPHA, BETA, L1, L2 = 10, 1.0, 1.0, 1e-4, 1e-4
SCALE = 40.0
THRESHOLD = 0.3
#: Longer words are read as parts of so many characters, each an n-gram of its own.
WORD_CHARS = 200
#: Words hashed at once, and words a worker remembers.
BLOCK_WORDS, MEMO_WORDS = 1 << 16, 200_000

_RUNS = re.compile(r"(.)\1+", re.S)
_LOWER, _UPPER, _DIGIT = re.compile(r"[^\W\d_A-Z]"), re.compile(r"[A-Z]"), re.compile(r"\d")


def word_shape(word: str) -> str:
    shape = _DIGIT.sub("0", _LOWER.sub("a", _UPPER.sub("A", word)))
    return _RUNS.sub(r"\1", shape)


class Hasher:
    """(word hash, shape hash) of words, remembered by the worker that holds the object."""

    def __init__(self):
        import xxhash

        self.hash = xxhash.xxh32_intdigest
        self.memo: dict[str, int] = {}

    def words(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for w in [w for w in set(words) if w not in memo]:
            memo[w] = self.hash(w.lower()) << 32 | self.hash(word_shape(w), 7)
        return np.array([memo[w] for w in words], dtype=np.uint64)


def _cells(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)  # a fixed odd multiplier; the upper bits are well mixed
    return (x >> np.uint64(64 - 18)).astype(np.int64) % CELLS


_PAIR = np.uint64(0xD6E8FEB86659FD93)  # odd: no word before is lost in the product


def features(text: str, hasher: Hasher):
    """Blocks of cells, one cell per n-gram; n-grams across a block's edge are counted in the later block."""
    words = [w[k : k + WORD_CHARS] for w in text.split() for k in range(0, len(w), WORD_CHARS)]
    last = np.empty(0, np.uint64)
    for at in range(0, len(words), BLOCK_WORDS):
        both = hasher.words(words[at : at + BLOCK_WORDS])
        word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
        chain = np.concatenate([last, both])
        own = chain >> np.uint64(32)
        start = max(len(last) - 1, 0)  # pairs before it were counted with the block before
        before, now = chain[start:-1], chain[start + 1 :]
        again = (before == now).astype(np.uint64)
        shapes = (before & np.uint64(0xFFFFFFFF)) * np.uint64(31) + (now & np.uint64(0xFFFFFFFF))
        pair = own[start:-1] * _PAIR + own[start + 1 :]
        triple = (own[:-2] * _PAIR + own[1:-1]) * _PAIR + own[2:]
        kinds = (word, shape, shapes, again, pair, triple)
        yield _cells(np.concatenate([x + np.uint64(1 << (33 + k)) for k, x in enumerate(kinds)]))
        last = chain[-2:]


def sparse(text: str, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(cells, values) of a text; values sum to ``SCALE``.  No words: no cells."""
    blocks = [np.unique(c, return_counts=True) for c in features(text, hasher)]
    if not blocks:
        return np.empty(0, np.int64), np.empty(0)
    cells, at = np.unique(np.concatenate([c for c, _ in blocks]), return_inverse=True)
    count = np.bincount(at, weights=np.concatenate([n for _, n in blocks]))
    return cells, SCALE * count / count.sum()


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: str, hasher: Hasher) -> float:
        total, n = 0.0, 0
        for cells in features(text, hasher):
            total += float(self.weights[cells].sum(dtype=np.float64))
            n += len(cells)
        return float(1.0 / (1.0 + np.exp(-np.clip(self.bias + (SCALE * total / n if n else 0.0), -30, 30))))


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Follow the regularised leader, per coordinate, in the order given, ``EPOCHS`` times."""
    z, n = np.zeros(CELLS + 1), np.zeros(CELLS + 1)  # the last coordinate is the bias, which isn't shrunk to zero

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for cells, values, label in rows:
            at, x = np.r_[cells, CELLS], np.r_[values, 1.0]
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(CELLS + 1))
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text divides by 5; a NULL id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Learn from at most ``max_rows`` labelled rows that aren't held out, chosen by hash of the id.

    Rows without label, id or text are left out; of several labels of an id the largest counts.  Executors hash
    texts to cells; one task, bounded by ``max_rows``, runs the updates.  With labels of no row: every score is 0.5.
    """
    labelled = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"))
    labelled = labelled.agg(F.max(label_col).cast("int").alias("y")).where(~held_out(F.col("id")))
    chosen = labelled.withColumn("order", F.xxhash64("id")).orderBy("order", "id").limit(max_rows)

    def hashed(batches):
        hasher = Hasher()
        for b in batches:
            found = [sparse(t, hasher) for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([c.astype(np.int32).tobytes() for c, _ in found], pa.binary()), pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary())],
                names=["order", "id", "y", "cells", "x"],
            )

    text = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    rows = text.join(F.broadcast(chosen), "id").select("order", "id", "y", "t").mapInArrow(hashed, "order long, id long, y int, cells binary, x binary")

    def fit(t: pa.Table) -> pa.Table:
        data = sorted(zip(*(t.column(c).to_pylist() for c in ("order", "id", "x", "cells", "y"))))[:max_rows]
        model = _ftrl([(np.frombuffer(c, np.int32), np.frombuffer(x, np.float32), y) for _, _, x, c, y in data])
        return pa.table({"weights": pa.array([model.weights.tobytes()], pa.binary()), "bias": pa.array([model.bias])})

    # An id may be repeated: what goes to the one task is cut to the first ``max_rows`` rows before.
    rows = rows.orderBy("order", "id", "x", "cells", "y").limit(max_rows)
    fitted = rows.withColumn("all", F.lit(True)).groupBy("all").applyInArrow(fit, "weights binary, bias double").first()
    if fitted is None:
        return Model(np.zeros(CELLS, np.float32), 0.0)
    return Model(np.frombuffer(bytes(fitted["weights"]), np.float32), fitted["bias"])


def _scores(model: Model, texts: pa.Array, hasher: Hasher) -> np.ndarray:
    return np.array([model.score(t or "", hasher) for t in texts.to_pylist()], dtype=np.float64)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted`` per input row; a text without words (or NULL) gets the bias's score."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        hasher, known = Hasher(), spread.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scores(known, b.column(1), hasher))], names=["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, score double")
    return slim.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows that score ``threshold`` or more, with their columns as they were."""
    spread = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        hasher, known = Hasher(), spread.value
        for b in batches:
            yield b.filter(pa.array(_scores(known, b.column(at), hasher) >= threshold))

    return docs.mapInArrow(run, docs.schema)
