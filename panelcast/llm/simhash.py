"""SimHash near-dedup with the general pigeonhole principle.

Bits are grouped by correlation into m partitions.  Give partition i a threshold t_i, with the sum of all t_i equal
to (links - m + 1), t_i >= -1: two fingerprints at a distance of ``links`` or less then differ by t_i bits or less in
some partition (-1: that partition is not looked at).  Dynamic programming over the candidate counts that each
threshold would bring picks m and the thresholds.  Fingerprints meet in buckets of equal partition values, where up
to t_i bits are masked out, and are verified there.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelcast.llm.buckets import crowded, links_of
from panelcast.llm.common import small_or_plain, stored, with_row
from panelcast.llm.components import components

BITS, SEED, SHINGLE, LINKS = 64, 42, 3, 3
PARTITIONS = (1, 2, 3, 4)
#: What one bucket entry costs, in verified candidates: it is written, shuffled and sorted.
ENTRY_COST = 20.0
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit b is set if it is set in over half of the shingle hashes; no words: 0."""
    import xxhash

    words = text.lower().split()  # bytes: only A-Z are lowered, only 0x20 and 0x09-0x0D separate
    if not words:
        return 0
    shingle = min(shingle, len(words))
    joined = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = np.r_[0, end[:-1] + 1]
    hashed = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        to = min(n, at + BLOCK)
        values = np.array([hashed(joined[a:b], SEED) for a, b in zip(start[at:to].tolist(), end[at + shingle - 1 : to + shingle - 1].tolist())], dtype=">u8")
        counts += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id_col, bits long`` per row; NULL and wordless texts have fingerprint 0."""

    def run(batches):
        for b in batches:
            values = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], names=[id_col, "bits"])

    slim = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"`{id_col}` long, bits long")


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """(number of fingerprints, 64 x 64 counts of fingerprints that have both bits set), over all of them."""

    def run(batches):
        both, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            on = _bits(b.column(0).to_numpy()).astype(np.float32)
            both += on.T @ on
            n += len(on)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1)), pa.array(np.r_[both.ravel(), n])], names=["at", "x"])

    found = nodes.select("node").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toPandas()
    out = np.zeros(BITS * BITS + 1)
    out[found["at"].to_numpy()] = found["x"].to_numpy()  # the last is the number of fingerprints
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


def _bits(x: np.ndarray) -> np.ndarray:
    return np.unpackbits(x.astype(np.int64).astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m groups of (nearly) equal size; a group takes in the free bit that correlates most with its members."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    correlation = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0)
    free, groups = set(range(BITS)), []
    for i in range(m):
        size = BITS // m + (i < BITS % m)
        left = sorted(free)
        group = [max(left, key=lambda b: (correlation[b, left].sum(), -b))]
        free.discard(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: (correlation[b, group].sum(), -b))
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def candidate_counts(n: int, both: np.ndarray, group: list[int], most: int) -> list[float]:
    """Expected pairs of fingerprints that differ by at most e = 0..most bits in a group, bits taken as independent."""
    p = both.diagonal()[group] / max(n, 1)
    ways = np.zeros(most + 1)
    ways[0] = 1.0
    for equal in p * p + (1 - p) * (1 - p):
        ways[1:] = ways[1:] * equal + ways[:-1] * (1 - equal)
        ways[0] *= equal
    return (np.cumsum(ways) * n * max(n - 1, 0) / 2).tolist()


def entries(width: int, e: int) -> int:
    """Bucket entries of a fingerprint in a partition of ``width`` bits with threshold e."""
    return 0 if e < 0 else sum(1 for _ in combinations(range(width), e)) if e else 1


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds e_i >= -1 that sum to ``budget`` at least cost; costs[i][e + 1] is the cost of threshold e."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for spent, (c, chosen) in best.items():
            for k, x in enumerate(cost):
                key = spent + k - 1
                if key not in after or c + x < after[key][0]:
                    after[key] = (c + x, [*chosen, k - 1])
        best = after
    return best[budget]


def plan_probes(n: int, both: np.ndarray, links: int = LINKS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is looked at, at the least estimated cost over all m."""
    plans = []
    for m in (m for m in PARTITIONS if m <= links + 1):
        groups = group_bits(n, both, m)
        costs = []
        for g in groups:
            found = candidate_counts(n, both, g, links)
            # With e > 0 a pair meets once for each mask that covers its differing bits; entries count by n.
            costs.append([0.0, *(entries(len(g), e) * n * ENTRY_COST + found[e] * max(1, entries(len(g), e) / 4) for e in range(min(links, 3) + 1))])
        cost, thresholds = allocate(costs, links - m + 1)
        plans.append((cost, m, [(g, e) for g, e in zip(groups, thresholds) if e >= 0]))
    return min(plans, key=lambda x: x[:2])[2]


def bucket_keys(nodes: DataFrame, probes: list[tuple[list[int], int]]) -> DataFrame:
    """``key, node``: fingerprints in the same bucket agree in a partition but for at most its threshold of bits.

    The key is the partition's value with ``threshold`` bits masked out, hashed together with the mask.
    """
    node, arrays = F.col("node"), []
    for i, (group, e) in enumerate(probes):
        mask = sum(1 << (BITS - 1 - b) for b in group)
        out = [mask & ~sum(1 << (BITS - 1 - b) for b in gone) for gone in combinations(group, e)]
        signed = [x - (1 << BITS) if x >> (BITS - 1) else x for x in out]
        masks = F.array(*[F.lit(x).cast("long") for x in signed])
        arrays.append(F.transform(masks, lambda x, i=i: F.xxhash64(node.bitwiseAND(x), x, F.lit(i))))
    return nodes.select(F.explode(F.concat(*arrays)).alias("key"), "node")


def _close(links: int):
    def of(t: pa.Table):
        x = t.column("node").to_numpy().view(np.uint64)
        return lambda i, j: np.bitwise_count(x[i] ^ x[j]) <= links

    return of


def near_fingerprints(prints: DataFrame, links: int = LINKS) -> DataFrame:
    """``bits, root`` for each distinct fingerprint that is linked with another."""
    nodes = stored(prints.select(F.col("bits").alias("node")).distinct(), "fingerprints")
    n, both = bit_statistics(nodes)
    keyed = stored(bucket_keys(nodes, plan_probes(n, both, links)), "bucket-keys")
    found = links_of(crowded(keyed), _close(links))
    return components(found).select(F.col("node").alias("bits"), "root")


def simhash_groups(docs: DataFrame, links: int = LINKS, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fingerprint, component_id`` per input row.

    ``component_id`` is the smallest id reachable over links between fingerprints at ``links`` bits or less; equal
    fingerprints are linked.  Rows with NULL ids get one too; it's NULL only if no row of the group has an id.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    grouped = prints.groupBy("bits").agg(F.min(id_col).alias("least"))
    roots = stored(near_fingerprints(prints, links), "simhash-roots")
    n = roots.count()
    named = grouped.join(small_or_plain(roots, n), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(named.join(least, "root").select("bits", "component_id"), "simhash-classes")
    out = prints.join(classes, "bits")
    return out.select(id_col, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows whose id is the smallest of its group, with all their columns; rows without id stay if their group has none."""
    marked, marked_name = with_row(docs)
    # Groups of rows: the number of the row stands for it, in the order of ids (ties: by row).
    groups = simhash_groups(marked, id_col=marked_name, text_col=text_col, **options).select(marked_name, "component_id")
    ids = marked.select(marked_name, F.col(id_col).alias("_id")).join(groups, marked_name)
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col(marked_name).alias("row"))
    first = ids.groupBy("component_id").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    dropped = ids.join(first, "component_id").where(F.col("first.row") != F.col(marked_name)).select(marked_name)
    dropped = stored(dropped, "simhash-dropped")
    return marked.join(small_or_plain(dropped, dropped.count()), marked_name, "left_anti").drop(marked_name)
