"""Exact dedup by composable polynomial fingerprints.

A text's fingerprint is its bytes as a polynomial, modulo primes.  The fingerprint of a text follows from those of its
parts: each part's, shifted by the length behind it, and added up.  So the parts of a huge text are hashed in different
tasks and their shares summed in any order.  Texts with equal length and fingerprints are then compared byte by byte,
a chunk at a time, with one text of their group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelcast.llm.common import ascii_lower, small_or_plain, stored, with_row

#: Mersenne prime 2^31 - 1, so products fit 64 bits; four bases give 124 bits.
PRIME = (1 << 31) - 1
BASES = (1_000_003, 69_069_069, 314_159_265, 1_618_033_988)
#: Texts of more characters than this are hashed in parts of so many.
CHUNK_CHARS = 1 << 20
#: Characters compared at a time, and rows that meet one copy of their group's text.
COMPARE_CHARS, MEETING_ROWS = 1 << 16, 512
_ROW = 256
#: base^255 .. base^0 in the columns; a byte times a power, 256 times, stays below 2^53: exact in doubles.
_POWERS = np.array([[pow(b, k, PRIME) for b in BASES] for k in range(_ROW - 1, -1, -1)], dtype=np.float64)
_STEP = [pow(b, _ROW, PRIME) for b in BASES]


def polynomial(data: bytes) -> list[int]:
    """For each base, the sum of byte i times base^(n - 1 - i), modulo the prime."""
    x = np.frombuffer(data, dtype=np.uint8)
    pad = -len(x) % _ROW
    if pad:
        x = np.concatenate([np.zeros(pad, np.uint8), x])
    value = (x.reshape(-1, _ROW).astype(np.float64) @ _POWERS).astype(np.uint64) % np.uint64(PRIME)
    step = list(_STEP)
    # Neighbours combine by the length of the right one, until one value is left.
    while len(value) > 1:
        if len(value) % 2:
            value = np.concatenate([np.zeros((1, len(BASES)), np.uint64), value])
        value = (value[0::2] * np.array(step, np.uint64) + value[1::2]) % np.uint64(PRIME)
        step = [x * x % PRIME for x in step]
    return value[0].tolist() if len(value) else [0] * len(BASES)


def shifted(values: list[int], behind: int) -> list[int]:
    """A part's share of the whole text's fingerprint, ``behind`` bytes before its end."""
    return [x * pow(b, behind, PRIME) % PRIME for x, b in zip(values, BASES)] if behind else values


NAMES = ["f0", "f1", "f2", "f3"]


def _hash_rows(batches):
    """(row, id, part, n bytes, behind) and text -> shares, with the digest of texts that come in one part."""
    for b in batches:
        behind = b.column("behind").to_pylist()
        texts = [t.as_buffer().to_pybytes().lower() for t in b.column("text")]
        shares = list(zip(*(shifted(polynomial(t), k) for t, k in zip(texts, behind)))) or [()] * len(BASES)
        digest = [hashlib.sha256(t).hexdigest() for t in texts]
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), b.column("bytes"), *[pa.array(s, pa.int64()) for s in shares], pa.array(digest)], names=["row", "id", "bytes", *NAMES, "sha256"])


_HASHED = "row long, id long, bytes long, f0 long, f1 long, f2 long, f3 long, sha256 string"


def fingerprints(rows: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``row, id, text`` -> ``row, id, bytes, f0..f3, sha256``, all of the text with A-Z lower-cased."""
    sized = rows.withColumn("bytes", F.octet_length("text").cast("long"))
    short = sized.where(F.octet_length("text") <= chunk_chars).withColumn("behind", F.lit(0).cast("long"))
    whole = short.mapInArrow(_hash_rows, _HASHED)
    huge = stored(sized.where(F.octet_length("text") > chunk_chars), "huge")
    if huge.isEmpty():
        return whole
    starts = F.sequence(F.lit(1), F.char_length("text"), F.lit(chunk_chars))
    parts = huge.select("row", "id", "bytes", F.posexplode(F.transform(starts, lambda s: F.substring(F.col("text"), s, F.lit(chunk_chars)))).alias("part", "text"))
    # How many bytes stand behind each part: lengths travel with the parts, which go to different tasks.
    sizes = huge.select("row", F.transform(F.transform(starts, lambda s: F.substring(F.col("text"), s, F.lit(chunk_chars))), lambda p: F.octet_length(p).cast("long")).alias("sizes"))
    after = lambda c: F.aggregate(F.slice(F.col("sizes"), c + 2, F.greatest(F.size("sizes") - c - 1, F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x)
    spread = parts.join(sizes, "row").withColumn("behind", after(F.col("part"))).repartition("row", "part")
    shares = spread.select("row", "id", "text", "bytes", "behind").mapInArrow(_hash_rows, _HASHED)
    summed = shares.groupBy("row", "id", "bytes").agg(*[(F.sum(f) % PRIME).alias(f) for f in NAMES])
    # A digest can't be put together from parts: it's taken over the whole text where it lies.
    digest = huge.select("row", F.sha2(ascii_lower(F.col("text")), 256).alias("sha256"))
    return whole.unionByName(summed.join(digest, "row"))


def differing_rows(rows: DataFrame, pointers: DataFrame) -> DataFrame:
    """``row`` of those whose text is not that of their group's first row.

    pointers: ``row, group, first, meetings`` of the rows with shared fingerprints.
    """
    members = pointers.join(rows.select("row", "text"), "row")
    chunks = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length("text"), F.lit(1)), F.lit(COMPARE_CHARS)), lambda s: ascii_lower(F.substring(F.col("text"), s, F.lit(COMPARE_CHARS))))
    cut = members.select("row", "group", "first", "meetings", F.posexplode(chunks).alias("chunk", "part"))
    # The first row's chunks stand once in each meeting; every meeting has at most some hundred rows.
    base = cut.where("row = first").select("group", F.explode(F.sequence(F.lit(0), F.col("meetings") - 1)).alias("meeting"), "chunk", F.col("part").alias("expected"))
    others = cut.where("row <> first").withColumn("meeting", F.pmod(F.xxhash64("row"), F.col("meetings").cast("long")).cast("int"))
    joined = others.join(base, ["group", "meeting", "chunk"], "left")
    return joined.where(~F.col("part").eqNullSafe(F.col("expected"))).select("row").distinct()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``id_col, keep_id, group_size, kept, text_sha256, row`` per input row.

    Texts are equal if they are identical after lower-casing A-Z; NULL counts as empty.  The row with the largest id
    stays; of repeated rows with that id one stays; NULL is the smallest id.
    """
    marked, name = with_row(docs.select(id_col, text_col))
    return _groups(marked, name, id_col, text_col, chunk_chars)


def _groups(marked: DataFrame, name: str, id_col: str, text_col: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The groups of rows that ``with_row`` has written."""
    rows = marked.select(F.col(name).alias("row"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    prints = stored(fingerprints(rows, chunk_chars), "fingerprints")
    content = ["bytes", *NAMES]
    last = F.max(F.struct("id", "row"))
    groups = prints.groupBy(*content).agg(F.count("*").alias("size"), last.alias("last")).where("size > 1")
    groups = stored(groups.select(*content, "size", F.col("last.row").alias("first"), F.col("last.id").alias("keep_id")), "copies")
    n_groups = groups.count()
    shared = prints.join(small_or_plain(groups, n_groups), content)
    shared = stored(shared.select("row", "id", "sha256", F.xxhash64(*content).alias("group"), "first", "keep_id", "size", F.ceil(F.col("size") / MEETING_ROWS).cast("int").alias("meetings")), "copy-rows")
    n_shared = shared.count()
    pointers = shared.select("row", "group", "first", "meetings")
    differing = stored(differing_rows(rows, small_or_plain(pointers, n_shared)), "differing") if n_shared else None
    if differing is not None and not differing.isEmpty():
        # Equal fingerprints of different texts: those groups go by digest as well.
        broken = shared.join(differing, "row", "left_semi").select("group").distinct()
        again = shared.join(broken, "group", "left_semi")
        anew = again.groupBy("group", "sha256").agg(F.count("*").alias("size"), F.max(F.struct("id", "row")).alias("last"))
        anew = again.select("row", "id", "group", "sha256").join(anew, ["group", "sha256"]).select("row", "id", "sha256", F.col("last.row").alias("first"), F.col("last.id").alias("keep_id"), "size")
        shared = shared.join(broken, "group", "left_anti").select(*anew.columns).unionByName(anew)
    found = shared.select("row", "first", "keep_id", "size")
    out = prints.select("row", "id", "sha256").join(small_or_plain(found, n_shared), "row", "left")
    alone = F.col("size").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("first") == F.col("row"))).alias("kept"),
        F.col("sha256").alias("text_sha256"),
        "row",
    )


def keep_last_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns as they were; see :func:`exact_groups` for NULL, ties and repeated rows."""
    marked, name = with_row(docs)
    dropped = stored(_groups(marked, name, id_col, text_col).where("NOT kept").select(F.col("row").alias(name)), "dropped")
    return marked.join(small_or_plain(dropped, dropped.count()), name, "left_anti").drop(name)
