"""Best-fit packing of tokenised documents into sequences, with certified repacking.

Every document is cut into pieces of at most ``capacity`` tokens.  Pieces are dealt to partitions, each packed by
best-fit decreasing.  Dual feasible functions bound the number of sequences a partition needs from below.  A partition
that meets its bound is certified: it keeps its sequences, all but the emptiest.  A partition with a gap keeps only
its completely full ones.  What is not kept is exchanged: dealt again, over fewer partitions, and packed again, until
one partition packs all that is left, or a round saves nothing.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from panelcast.llm.common import stored, with_row

CAPACITY = 4096
END_ID = 1
#: Pieces that one task packs at once: some 50 bytes each.
PARTITION_PIECES = 24_000
#: Characters that are tokenised at a time.
BLOCK_CHARS = 1 << 20


#: A character for which the steps before the merges are more than lower-casing and cutting at marks and digits (or, for
#: the apostrophe, follow rules of their own), and a word between blanks with one.
_ODD = re.compile(r"[^A-Za-zÀ-ÖØ-öø-ÿ0-9 \n!-&(-/:-@\[-`{-~]")
_ODD_WORD = re.compile(rf"((?:[^ \n]*{_ODD.pattern}[^ \n]*)+)")
_CUT = re.compile(r"([!-/:-@\[-`{-~]+|[0-9])")
#: Stands for the end of a word among its bytes.
END_MARK = " "
#: tiktoken looks for special tokens in every text, even where none is allowed; without any to look for, it stops at each
#: character.  This one is never allowed, so a text that holds it is encoded like any other.
UNUSED_SPECIAL = {"<|unused|>": 1 << 30}


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if visible, else the next one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordTokenizer:
    """Ids of a whole text as little-endian unsigned 32-bit bytes, word by word.

    For vocabularies that drop white space and join no characters across it; others are refused.  Words of plain letters,
    marks and digits go straight to the merges (by tiktoken, whose ranks are the ids; a blank stands for the end of a word
    there), any other word through the library's whole chain of steps.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        said = json.loads(self.tokenizer.to_str())
        ranks = _ranks_of(said)
        if ranks is None:
            raise ValueError(f"{path} isn't a vocabulary of lower-case words with word ends")
        self.special = re.compile("|".join(re.escape(t["content"]) for t in said["added_tokens"]) or r"(?!)")
        self.merges = tiktoken.Encoding("words", pat_str=f"[^{END_MARK}]+{END_MARK}", mergeable_ranks=ranks, special_tokens=UNUSED_SPECIAL)

    def _plain(self, text: str) -> bytes:
        words = _CUT.sub(r" \1 ", text.lower().replace("\n", " "))
        return self.merges.encode_to_numpy(words + END_MARK, disallowed_special=()).astype("<u4").tobytes()

    def _library(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def blocks(self, text: str) -> Iterator[bytes]:
        """The ids, a block of text after the other; blocks end at white space."""
        at = 0
        while at < len(text):
            end = at + BLOCK_CHARS
            if end < len(text):
                cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
                if cut <= at:  # no white space in the block: it goes on to the next
                    cut = min((x for x in (text.find(" ", end), text.find("\n", end)) if x >= 0), default=len(text))
                end = cut
            block = text[at:end]
            if self.special.search(block):
                yield self._library(block)
            elif not _ODD.search(block):
                yield self._plain(block)
            else:
                for k, part in enumerate(_ODD_WORD.split(block)):
                    yield self._library(part) if k % 2 else self._plain(part)
            at = end + 1


def _ranks_of(said: dict) -> dict[bytes, int] | None:
    """Ranks of a vocabulary whose letters are bytes, whose words end in a mark and whose ids rise with its merges, else None."""
    model, suffix = said["model"], said["model"].get("end_of_word_suffix")
    steps = [n.get("type") for n in (said["normalizer"] or {}).get("normalizers", [])]
    cuts = [p.get("type") for p in (said["pre_tokenizer"] or {}).get("pretokenizers", [])]
    plain = model["type"] == "BPE" and suffix and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    if not plain or steps != ["NFC", "Replace", "Lowercase"] or cuts != ["Split", "ByteLevel"] or said["pre_tokenizer"]["pretokenizers"][0]["behavior"] != "Removed":
        return None
    letter_of = byte_letters()
    byte, end = {letter: bytes([b]) for b, letter in letter_of.items()}, letter_of[ord(END_MARK)]
    spelled = lambda t: b"".join(byte[c] for c in t.removesuffix(suffix)) + (END_MARK.encode() if t.endswith(suffix) else b"")
    # No plain word holds the byte that stands for the end, so the letter's own place is free for it.
    ranks = {spelled(t): i for t, i in model["vocab"].items() if t != end}
    merged = ["".join(m) for m in model["merges"]]
    made = [model["vocab"][t] for t in merged]
    letters = set(model["vocab"].values()) - set(made)
    if made != sorted(set(made)) or max(letters) > made[0]:
        return None
    return ranks | {END_MARK.encode(): model["vocab"][end]}


def pieces_of(blocks: Iterator[bytes], capacity: int, end_id: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, crc32 of the ids) of each piece, holding one piece and one block at a time."""
    size, start, held = 4 * capacity, 0, b""
    for block in itertools.chain(blocks, [int(end_id).to_bytes(4, "little")]):
        held += block
        while len(held) > size:
            yield start, capacity, zlib.crc32(held[:size])
            start, held = start + capacity, held[size:]
    yield start, len(held) // 4, zlib.crc32(held)


def tokenise(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` per piece; NULL text counts as empty and gives one piece of one token."""

    def run(batches):
        tokenizer = WordTokenizer(tokenizer_path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows = [(d, k, *p) for d, t in zip(b.column(0).to_pylist(), texts) for k, p in enumerate(pieces_of(tokenizer.blocks(t), capacity, end_id))]
            columns = zip(*rows) if rows else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that these lengths need at least.

    Each dual feasible function maps lengths to shares whose sum in any sequence is at most one.
    """
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = float((count * size).sum()) / capacity
    # Lengths over capacity - k count as whole sequences, lengths under k as nothing.
    at_least, mass = np.cumsum(count[::-1])[::-1], np.cumsum(count * size)
    k = np.arange(1, capacity // 2 + 1)
    whole = np.where(capacity - k + 1 <= capacity, at_least[capacity - k + 1], 0)
    between = mass[capacity - k] - mass[k - 1]
    best = max(best, float((whole + between / capacity).max()))
    # Staircases: length x counts floor((n + 1) x / capacity) / n, or x / capacity where (n + 1) x divides evenly.
    for n in range(1, 21):
        steps = np.where((n + 1) * size % capacity == 0, size / capacity, ((n + 1) * size // capacity) / n)
        best = max(best, float((count * steps).sum()))
    return int(np.ceil(best - 1e-6))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Sequence number of each length: longest first, each into the fullest sequence that still has room."""
    order = np.argsort(-lengths, kind="stable")
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made = 0, 0  # bit r of rooms: some sequence has exactly r left
    out = np.empty(len(lengths), dtype=np.int64)
    for i, x in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> x
        if fitting:
            r = x + (fitting & -fitting).bit_length() - 1
            bin_ = by_room[r].pop()
            if not by_room[r]:
                rooms &= ~(1 << r)
        else:
            r, bin_ = capacity, made
            made += 1
        out[i] = bin_
        if r > x:
            by_room[r - x].append(bin_)
            rooms |= 1 << (r - x)
    return out


def _pack_partition(capacity: int):
    def run(part: pa.Table) -> pa.Table:
        keys = [("length", "descending"), *((c, "ascending") for c in ("doc_id", "piece", "start", "ids_crc32"))]
        part = part.take(pc.sort_indices(part, sort_keys=keys))
        lengths = part.column("length").to_numpy()
        bins = best_fit_decreasing(lengths, capacity)
        filled = np.bincount(bins, weights=lengths).astype(np.int64)
        bound = lower_bound(lengths, capacity)
        if len(filled) == bound:
            leaves = np.zeros(len(filled), dtype=bool)
            leaves[int(np.argmin(filled))] = filled.min() < capacity
        else:
            leaves = filled < capacity
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.r_[True, bins[order][1:] != bins[order][:-1]]
        offset = np.empty(len(bins), dtype=np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        n = len(bins)
        for name, values in (("bin", bins), ("offset", offset), ("leaves", leaves[bins]), ("bins", np.full(n, len(filled))), ("bound", np.full(n, bound))):
            part = part.append_column(name, pa.array(values))
        return part

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """``pieces`` (as :func:`tokenise` gives them) with ``sequence_id``, ``offset`` and ``certified``.

    Every piece is packed exactly once, repeated rows too; an empty table gives no rows.  ``certified`` says that the
    partition a piece was last packed in provably couldn't do with fewer sequences.  Rounds go on as long as each needs
    fewer sequences than the one before for the same pieces.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # Pieces are dealt by a number of their own, so equal ones, or those without id, are spread as well.
    numbered, row = with_row(pieces.select(*names))
    made = f"doc_id long, piece int, start long, length long, ids_crc32 long, {row} long, part int, bin long, offset long, leaves boolean, bins long, bound long"
    pool, kept, last, dealt, k = numbered, [], None, 0, 0
    while True:
        n = pool.count()
        parts = max(1, -(-n // partition_pieces))
        # The round is part of the hash, so a partition meets others in each round.
        part = F.pmod(F.xxhash64(row, F.lit(k)), F.lit(parts)).cast("int")
        packed = stored(pool.withColumn("part", part).groupBy("part").applyInArrow(_pack_partition(capacity), made), "packed")
        # 2^24 sequences a partition: far more than it has pieces.
        packed = packed.withColumn("sequence_id", (F.col("part") + F.lit(dealt).cast("long")) * (1 << 24) + F.col("bin"))
        dealt, k = dealt + parts, k + 1
        if last is not None:
            used = lambda df: df.select("sequence_id").distinct().count()
            if used(packed) >= used(last):
                kept.append(last)
                break
        if parts == 1:
            kept.append(packed)
            break
        kept.append(packed.where("NOT leaves"))
        last = packed.where("leaves")
        pool = last.select(*names, row)
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out.select(*names, "sequence_id", F.col("offset").cast("long").alias("offset"), (F.col("bins") == F.col("bound")).alias("certified"))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise, cut and pack whole documents; see :func:`tokenise` and :func:`pack`."""
    return pack(tokenise(docs, tokenizer_path, id_col, text_col, capacity, end_id), capacity)
