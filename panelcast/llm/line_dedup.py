"""Line dedup through a sharded minimal perfect hash.

The distinct lines that enough documents hold are known by 128-bit hashes.  Each shard of them becomes a minimal
perfect hash with arrays beside it: fingerprint, document count and keeper (the largest document id).  Documents send
hashes of their lines, never the lines, and read the arrays.  The most frequent lines, of which there are few, form a
shard of their own that every task holds, so a line that is everywhere sends no hash to any one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.llm.common import BLANKS, ascii_lower, stored

MIN_CHARS, MIN_DOCS = 20, 3
#: Lines of one shard: about 1.5 MB of arrays.
SHARD_LINES = 50_000
#: Hashes that documents send to one shard, on average.
SHARD_PROBES = 500_000
#: Lines of the shard that every task holds (24 bytes each).  Each has over 1 / HOT_LINES of all repeated (line,
#: document) pairs, so there can't be more of them, and no other line sends more than that share to one place.
HOT_LINES = 10_000
#: Cells of a level of the minimal perfect hash for each line that is left.
CELLS = 1.5

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed multipliers of the splitmix64 finisher


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@dataclass
class LineIndex:
    """Minimal perfect hash (levels of bits) with arrays by slot.  Keys are pairs of 64-bit hashes."""

    sizes: list[int]
    bits: np.ndarray
    fingerprints: np.ndarray
    counts: np.ndarray
    keepers: np.ndarray

    @staticmethod
    def _cell(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        return _mix(a ^ _mix(b + np.uint64(level + 1))) % np.uint64(size)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> LineIndex:
        a, b = a.view(np.uint64), b.view(np.uint64)
        left, sizes, levels = np.arange(len(a)), [], []
        while len(left):
            size = max(8, int(CELLS * len(left)) // 8 * 8)
            cell = cls._cell(a[left], b[left], len(sizes), size)
            alone = np.bincount(cell.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[cell.astype(np.int64)]]
        index = cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool), b.copy(), counts.copy(), keepers.copy())
        slot = index.slots(a, b)
        for name, values in (("fingerprints", b), ("counts", counts), ("keepers", keepers)):
            out = np.empty_like(values)
            out[slot] = values
            setattr(index, name, out)
        return index

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each key; -1, or the slot of some other key, for a key that isn't in the index."""
        rank = np.cumsum(self.bits)
        out, open_, base = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = base + self._cell(a[open_], b[open_], level, size).astype(np.int64)
            hit = self.bits[at]
            out[open_[hit]] = rank[at[hit]] - 1
            open_, base = open_[~hit], base + size
        return out

    def probe(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each key (signed 64-bit pairs), -1 for keys that aren't in the index."""
        a, b = a.view(np.uint64), b.view(np.uint64)
        slot = self.slots(a, b)
        if not len(self.fingerprints):
            return slot
        return np.where((slot >= 0) & (self.fingerprints[slot] == b), slot, -1)

    def pack(self) -> tuple:
        return list(self.sizes), np.packbits(self.bits).tobytes(), self.fingerprints.tobytes(), self.counts.tobytes(), self.keepers.tobytes()

    @classmethod
    def unpack(cls, sizes, bits, fingerprints, counts, keepers) -> LineIndex:
        flags = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool)
        return cls(list(sizes), flags, np.frombuffer(fingerprints, np.uint64), np.frombuffer(counts, np.int64), np.frombuffer(keepers, np.int64))


INDEX_FIELDS = "sizes array<long>, bits binary, fingerprints binary, counts binary, keepers binary"
#: A document without id never is the largest; its id stands as the smallest number.
NO_ID = -(2**63)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Blanks stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, tag, text): rows with the same id and text share doc and tag, and share their result."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(id_col).alias("own_id"), text.alias("text")).withColumn("tag", F.xxhash64("text"))


def _key_hashes(min_chars: int) -> Column:
    keys = F.transform(lines_of(F.col("text")), line_key)
    hashed = F.transform(keys, lambda k, i: F.when(F.char_length(k) >= min_chars, F.struct(i.alias("at"), F.xxhash64(k).alias("a"), F.xxhash64(k, F.lit(1)).alias("b"))))
    return F.filter(hashed, lambda x: x.isNotNull())


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``a, b, n, keeper`` for each line key (as two hashes) in ``min_docs`` or more documents."""
    keys = F.transform(_key_hashes(min_chars), lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))
    each = _marked(docs, id_col, text_col).select("doc", F.explode(F.array_distinct(keys)).alias("k"))
    found = each.groupBy("k.a", "k.b").agg(F.count("*").alias("n"), F.max("doc").alias("keeper"))
    return found.where(F.col("n") >= min_docs)


def build_shards(repeated: DataFrame, shards: int) -> DataFrame:
    """One row per shard: its minimal perfect hash and arrays."""

    def build(t: pa.Table) -> pa.Table:
        shard, a, b, n, keeper = (t.column(c).to_numpy() for c in ("shard", "a", "b", "n", "keeper"))
        row = LineIndex.build(a, b, n, keeper).pack()
        return pa.table([[int(shard[0])], *[[x] for x in row]], schema=pa.schema([("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), *[(c, pa.binary()) for c in ("bits", "fingerprints", "counts", "keepers")]]))

    shard = F.pmod(F.xxhash64("a", "b"), F.lit(shards)).cast("long")
    return repeated.withColumn("shard", shard).groupBy("shard").applyInArrow(build, "shard long, " + INDEX_FIELDS)


def _probe_hot(hot: bytes | None, pass_on: bool):
    """Answer probes of the hot lines at once, pass the others on to their shard."""

    def run(batches: Iterator[pa.RecordBatch]):
        import pickle

        index = LineIndex.unpack(*pickle.loads(hot)) if hot else None
        for batch in batches:
            a, b, doc = (batch.column(c).to_numpy() for c in ("a", "b", "doc"))
            slot = index.probe(a, b) if index else np.full(len(a), -1)
            known = slot >= 0
            keeper = index.keepers[slot] if index and len(index.keepers) else np.zeros(len(a), np.int64)
            drops = known & (keeper != doc)
            keep = drops | (~known & pass_on)
            out = batch.append_column("drops", pa.array(drops))
            yield pa.RecordBatch.from_arrays([*out.filter(pa.array(keep)).columns], names=out.schema.names)

    return run


def _probe_shards(batches: Iterator[pa.RecordBatch]):
    """Rows come by shard, its index first; only one index and one batch of probes are held."""
    index, names = None, ["doc", "tag", "at"]
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        is_index = batch.column("sizes").is_valid().to_numpy(zero_copy_only=False)
        starts = np.unique(np.r_[0, np.nonzero(np.r_[False, shard[1:] != shard[:-1]] | is_index)[0]]).tolist()
        for lo, hi in zip(starts, [*starts[1:], len(shard)]):
            if is_index[lo]:
                index = int(shard[lo]), LineIndex.unpack(*(batch.column(c)[lo].as_py() for c in ("sizes", "bits", "fingerprints", "counts", "keepers")))
                lo += 1
            if lo < hi and index and index[0] == shard[lo]:
                rows = batch.slice(lo, hi - lo)
                slot = index[1].probe(rows.column("a").to_numpy(), rows.column("b").to_numpy())
                drops = (slot >= 0) & (index[1].keepers[slot] != rows.column("doc").to_numpy())
                yield rows.select(names).filter(pa.array(drops))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, kept_text, n_lines, n_dropped``, one row per input row.

    A line whose key has at least ``min_chars`` characters and is found in at least ``min_docs`` rows goes, except in
    the row with the largest id that holds it (in all rows of that id, if it's repeated; a NULL id is never the
    largest unless all are NULL).  NULL text counts as one empty line.  Other columns are ignored.
    """
    import pickle

    spark = docs.sparkSession
    repeated = stored(repeated_lines(docs, min_chars, min_docs, id_col, text_col), "repeated-lines")
    total, n = repeated.agg(F.sum("n"), F.count("*")).first()
    marked = _marked(docs, id_col, text_col)
    probes = marked.select("doc", "tag", F.explode(_key_hashes(min_chars)).alias("k")).select("doc", "tag", "k.at", "k.a", "k.b")
    limit = -(-(total or 0) // HOT_LINES) + 1
    hot_rows = repeated.where(F.col("n") >= limit).toArrow()  # HOT_LINES at most, see there
    hot = None
    if hot_rows.num_rows:
        hot = pickle.dumps(LineIndex.build(*(hot_rows.column(c).to_numpy() for c in ("a", "b", "n", "keeper"))).pack())
    n_cold = n - hot_rows.num_rows
    asked = probes.mapInArrow(_probe_hot(hot, n_cold > 0), "doc long, tag long, at int, a long, b long, drops boolean")
    asked = stored(asked, "line-probes")
    drops = asked.where("drops").select("doc", "tag", "at")
    if n_cold:
        rest = asked.where("NOT drops").drop("drops")
        shards = -(-max(n_cold, rest.count() * SHARD_LINES // SHARD_PROBES) // SHARD_LINES)
        index = build_shards(repeated.where(F.col("n") < limit), shards)
        shard = F.pmod(F.xxhash64("a", "b"), F.lit(shards)).cast("long")
        both = rest.withColumn("shard", shard).unionByName(index, allowMissingColumns=True)
        both = both.repartition("shard").sortWithinPartitions("shard", F.col("sizes").isNull())
        drops = drops.unionByName(both.mapInArrow(_probe_shards, "doc long, tag long, at int"))
    per_doc = stored(drops.groupBy("doc", "tag").agg(F.collect_set("at").alias("gone")), "line-drops")
    lines = lines_of(F.col("text"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")), lambda i: F.col("lines")[i]), "\n")
    )
    joined = marked.join(per_doc, ["doc", "tag"], "left").withColumn("lines", lines)
    return joined.select(
        F.col("own_id").alias(id_col),
        kept.alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
    )
