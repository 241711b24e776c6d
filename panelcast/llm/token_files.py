"""Token ids in ORC files: integers run-length encoded, row indexes and Bloom filters on document ids.

Documents are dealt by id, sorted and encoded, so files, and the stripes in them, hold rising ids.  Stripes are read in
parallel; ids asked for are looked up in the files' metadata (least and largest id of every 1,000 rows, and a Bloom
filter for ids in between), so stripes and row groups without them aren't read.  A document of very many tokens is
several rows, whose checksums are combined without putting the parts together.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from panelcast.llm.common import small_or_plain
from panelcast.llm.packing import UNUSED_SPECIAL, byte_letters

END_ID = 2
#: Ids in a row at most, and ids that leave a worker at a time.
PART_IDS, BATCH_IDS = 1 << 20, 1 << 20
#: Rows that an entry of the row index speaks for, and the share of ids a Bloom filter may take for present.
INDEX_ROWS, FALSE_SHARE = 1_000, 0.01
#: ``file`` and ``place``: which file, and which document of it; ``before``: ids of the documents before it in the file.
FILE_SCHEMA = "doc_id long, file int, place long, part int, parts int, before long, n int, ids array<int>"
#: White space of this length goes to the library itself: the pattern below would be matched by deep recursion.
LONG_BLANKS = 10_000
#: Fixed by the vocabulary: the pattern of byte-level vocabularies, which its file names by "use_regex".
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for texts in which no white space follows white space; it needs no look ahead and runs faster.
SHORT_PATTERN = PATTERN.replace(r"|\s+(?!\S)|\s+", r"|\s")
_BLANK_RUN = re.compile(r"\s\s")


class ByteTokenizer:
    """Ids of whole texts by a byte-level vocabulary file of the tokenizers library.

    Where the file describes plain byte-level merging, tiktoken does the same merges by the same ranks, several times as
    fast; texts that name a special token or hold very long white space, and all texts for any other kind of file, go
    through the library itself.
    """

    def __init__(self, path: str):
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        said = json.loads(self.library.to_str())
        special = [re.escape(t["content"]) for t in said["added_tokens"]]
        self.special = re.compile("|".join(special)) if special else None
        self.long_blanks = re.compile(r"\s{%d}" % LONG_BLANKS)
        ranks, self.fast = _ranks_of(said), None
        if ranks is not None:
            import tiktoken

            self.fast, self.runs = (tiktoken.Encoding("vocabulary", pat_str=p, mergeable_ranks=ranks, special_tokens=UNUSED_SPECIAL) for p in (SHORT_PATTERN, PATTERN))

    def __call__(self, text: str) -> np.ndarray:
        own = self.fast is None or (self.special is not None and self.special.search(text))
        if own or (len(text) >= LONG_BLANKS and self.long_blanks.search(text)):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.int32)
        return (self.runs if _BLANK_RUN.search(text) else self.fast).encode_to_numpy(text, disallowed_special=()).astype(np.int32)


def _ranks_of(said: dict) -> dict[bytes, int] | None:
    """The ranks of a vocabulary that is nothing but byte-level merges in the order of its ids, else None."""
    steps, model = said["pre_tokenizer"] or {}, said["model"]
    plain = steps.get("type") == "ByteLevel" and steps.get("use_regex") and not steps.get("add_prefix_space") and said["normalizer"] is None
    special = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if not plain or model["type"] != "BPE" or any(model.get(k) for k in special):
        return None
    made = [model["vocab"]["".join(m)] for m in model["merges"]]
    byte = {letter: b for b, letter in byte_letters().items()}
    if made != sorted(set(made)) or not all(c in byte for t in model["vocab"] for c in t):
        return None
    return {bytes(byte[c] for c in t): i for t, i in model["vocab"].items()}


def _encoded(tokenizer_path: str, end_id: int, part_ids: int):
    names = [f.split()[0] for f in FILE_SCHEMA.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]):
        tokenizer = ByteTokenizer(tokenizer_path)
        file, place, before = TaskContext.get().partitionId(), 0, 0
        rows: list[tuple] = []
        ids: list[np.ndarray] = []
        size = 0

        def batch() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
            return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*rows), types)), lists], names=names)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                whole = np.append(tokenizer(text.as_py()), np.int32(end_id))
                parts = -(-len(whole) // part_ids)
                for k in range(parts):
                    cut = whole[k * part_ids : (k + 1) * part_ids]
                    rows.append((doc, file, place, k, parts, before, len(cut)))
                    ids.append(cut)
                    size += len(cut)
                    if size >= BATCH_IDS:
                        yield batch()
                        rows, ids, size = [], [], 0
                place, before = place + 1, before + len(whole)
        if rows:
            yield batch()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, part_ids: int = PART_IDS) -> None:
    """Encode whole texts, each with ``end_id`` behind it, and write them in ascending order of ids.

    NULL text counts as empty (the end id alone); NULL ids come first; of equal ids, the row read first comes first, and
    each has its own entry.  Other columns are ignored; an empty table gives files without rows.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("read"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("read").asc()]
    dealt = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    encoded = dealt.mapInArrow(_encoded(tokenizer_path, end_id, part_ids), FILE_SCHEMA)
    options = {"orc.row.index.stride": INDEX_ROWS, "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": FALSE_SHARE}
    encoded.write.options(**{k: str(v) for k, v in options.items()}).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows, as :data:`FILE_SCHEMA` names them; a filter on ``doc_id`` is answered from metadata first."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


#: x^(2^k) modulo the checksum's polynomial, bits reversed, as the checksum keeps them.
_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials over bits, modulo the checksum's."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = (b >> 1) ^ (_POLYNOMIAL if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two byte strings in a row from those of each: the first is moved on by the length of the second."""
    power, square, n = 1 << 31, 1 << 30, 8 * second_bytes
    while n:
        if n & 1:
            power = _times(square, power)
        square, n = _times(square, square), n >> 1
    return _times(power, first) ^ second


def _checksums(batches):
    """``ids`` -> their crc32 as little-endian 32-bit integers, straight from the column's buffer."""
    for b in batches:
        lists = b.column("ids")
        values = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        raw = memoryview(np.ascontiguousarray(values)).cast("B")
        crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lists.value_lengths().to_pylist())]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(crc, pa.int64())], names=[*b.schema.names[:-1], "crc"])


def _joined(batches):
    """Documents in parts -> checksum of the whole."""
    for b in batches:
        out = []
        for parts in b.column("pieces").to_pylist():
            crc = 0
            for p in parts:
                crc = joined_crc(crc, p["crc"], 4 * p["n"])
            out.append(crc)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.int64())], names=[*b.schema.names[:-1], "crc"])


def documents(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document of :func:`read_tokens`; ``start``: ids of all documents before it."""
    rows = tokens.select("doc_id", "file", "place", "part", "parts", "before", "n", "ids")
    sized = "doc_id long, file int, place long, part int, parts int, before long, n long"
    rows = rows.withColumn("n", F.col("n").cast("long"))
    # Each kind is read by itself: the files' metadata tell where there are documents in parts.
    whole, cut = (rows.where(w).mapInArrow(_checksums, sized + ", crc long") for w in ("parts = 1", "parts > 1"))
    names = ["doc_id", "file", "before", "n", "crc"]
    # Parts of a document are few (a million ids each); only their checksums meet.
    pieces = F.array_sort(F.collect_list(F.struct("part", "n", "crc"))).alias("pieces")
    cut = cut.groupBy("file", "place").agg(F.first("doc_id").alias("doc_id"), F.first("before").alias("before"), F.sum("n").alias("n"), pieces)
    cut = cut.select("doc_id", "file", "before", "n", "pieces").mapInArrow(_joined, "doc_id long, file int, before long, n long, crc long")
    # One row per file that a task has written, from two short columns: they are few enough to be added up in one place.
    totals = tokens.groupBy("file").agg(F.sum(F.col("n").cast("long")).alias("total"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    placed = whole.select(*names).unionByName(cut).join(small_or_plain(starts, starts.count()), "file")
    return placed.select("doc_id", (F.col("base") + F.col("before")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
