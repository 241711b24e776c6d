"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding is an agenda of adjacent symbol pairs: the pair whose joined piece scores highest (the leftmost of equals) is
merged first, and its new neighbours enter the agenda, until no pair forms a piece.  Short chunks run many agendas side
by side in numpy; a long chunk runs one on a heap.  If no piece has a space mark after another character, merges never
cross the start of a run of spaces, so a text is the sequence of its chunks, and a worker remembers frequent ones.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Fixed by the model format: the mark that stands for a space, and the types of pieces.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Chunks of at most this many symbols run side by side.
SHORT = 48
#: Chunks a worker remembers, and their longest length; characters of a text encoded at a time.
MEMO_CHUNKS, MEMO_CHARS, BLOCK_CHARS = 250_000, 48, 1 << 19
_NONE = np.int64(2**62)


def read_model(path: str) -> tuple[list[tuple[str, float, int]], dict]:
    """Pieces (text, score, type) and the settings that matter, read through the library."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    del sentencepiece
    n, t = model.normalizer_spec, model.trainer_spec
    known = {"bpe": t.model_type == 2, "identity": not n.precompiled_charsmap, "suffix": t.treat_whitespace_as_suffix}
    if not known["bpe"] or not known["identity"] or known["suffix"] or n.remove_extra_whitespaces or not n.escape_whitespaces:
        raise ValueError(f"not a merge-type vocabulary over unchanged text: {path}")
    return [(p.piece, p.score, p.type) for p in model.pieces], {"prefix": n.add_dummy_prefix, "bytes": t.byte_fallback}


class Vocabulary:
    """Pieces, the pairs that merge, and agendas over them."""

    def __init__(self, path: str):
        self.path = path
        self.pieces, settings = read_model(path)
        if any(t in (USER_DEFINED, UNUSED) for _, _, t in self.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.prefix, self.bytes = settings["prefix"], settings["bytes"]
        self.ids = {p: i for i, (p, _, t) in enumerate(self.pieces) if t == NORMAL}
        self.unknown = next(i for i, (_, _, t) in enumerate(self.pieces) if t == UNKNOWN)
        self.byte_ids = {int(p[1:-1], 16): i for i, (p, _, t) in enumerate(self.pieces) if t == BYTE}
        self.written = {i: p.replace(SPACE, " ") for p, i in self.ids.items()}
        self.independent = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        # Symbols: pieces by id, then characters that are no piece but stand inside one.
        symbols = dict(self.ids)
        for p in self.ids:
            for c in p:
                symbols.setdefault(c, len(self.pieces) + len(symbols))
        self.symbols, self.other = symbols, 2 * len(self.pieces) + len(symbols)
        self.by_character = np.full(0x110000, self.other, dtype=np.int32)
        for c, x in symbols.items():
            if len(c) == 1:
                self.by_character[ord(c)] = x
        scores = sorted({-self.pieces[i][1] for i in self.ids.values()})
        rank_of = {s: r for r, s in enumerate(scores)}
        self.rank = {i: rank_of[-self.pieces[i][1]] for i in self.ids.values()}
        found = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    found[a, b] = i
        self.merges = found
        self.width = np.int64(self.other + 1)
        keys = np.array([a * int(self.width) + b for a, b in found], dtype=np.int64)
        joined = np.array(list(found.values()), dtype=np.int64)
        ranks = np.array([self.rank[i] for i in found.values()], dtype=np.int64)
        # An open table: a key sits in the first free cell from its own on.
        self.cells = 1 << (4 * len(keys)).bit_length()
        self.keys, self.joined = np.full(self.cells, -1, dtype=np.int64), np.zeros(self.cells, dtype=np.int64)
        self.joined_rank, self.reach = np.full(self.cells, _NONE), 0
        at, open_ = self._cell(keys), np.arange(len(keys))
        while len(open_):
            self.reach += 1
            free = open_[self.keys[at[open_]] < 0]
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.joined[at[put]], self.joined_rank[at[put]] = keys[put], joined[put], ranks[put]
            open_ = np.setdiff1d(open_, put)
            at[open_] = (at[open_] + 1) % self.cells

    def _cell(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.int64(0x9E3779B97F4A7C1)) >> np.int64(20)) % self.cells

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of symbols a and b joined; rank ``_NONE`` if that is no piece."""
        key = a * self.width + b
        at = self._cell(key)
        rank, piece = np.full(len(key), _NONE), np.zeros(len(key), dtype=np.int64)
        open_ = np.arange(len(key))
        for _ in range(self.reach):
            there = self.keys[at[open_]]
            hit = there == key[open_]
            got = open_[hit]
            rank[got], piece[got] = self.joined_rank[at[got]], self.joined[at[got]]
            open_ = open_[~hit & (there >= 0)]
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) % self.cells
        return rank, piece

    def symbols_of(self, chunk: str) -> list[int]:
        get, other = self.symbols.get, self.other
        return [get(c, other) for c in chunk]

    def ids_of(self, chunk: str, lengths: list[int], symbols: list[int]) -> list[int]:
        """Ids of the final symbols; a character that is no piece gives its bytes, or the unknown id."""
        if all(s < len(self.pieces) for s in symbols):
            return symbols
        out, at = [], 0
        for s, n in zip(symbols, lengths):
            if s < len(self.pieces):
                out.append(s)
            elif self.bytes:
                out.extend(self.byte_ids[x] for x in chunk[at : at + n].encode("utf-8"))
            else:
                out.append(self.unknown)
            at += n
        return out

    def encode_long(self, chunk: str) -> list[int]:
        """One agenda on a heap: entries (rank, position); an entry whose symbols have changed is passed over."""
        symbols = self.symbols_of(chunk)
        n = len(symbols)
        before, after, lengths = list(range(-1, n - 1)), list(range(1, n + 1)), [1] * n
        merges, rank, agenda = self.merges, self.rank, []

        def enter(i):
            j = after[i]
            if j < n and (piece := merges.get((symbols[i], symbols[j]))) is not None:
                heapq.heappush(agenda, (rank[piece], i, symbols[i], symbols[j], piece))

        for i in range(n - 1):
            enter(i)
        while agenda:
            _, i, a, b, piece = heapq.heappop(agenda)
            j = after[i]
            if lengths[i] == 0 or symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], lengths[i] = piece, lengths[i] + lengths[j]
            lengths[j], after[i] = 0, after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                enter(before[i])
            enter(i)
        live = [i for i in range(n) if lengths[i]]
        return self.ids_of(chunk, [lengths[i] for i in live], [symbols[i] for i in live])

    def encode_short(self, chunks: list[str]) -> list[list[int]]:
        """The agendas of many short chunks, one merge of each per step."""
        sizes = np.array([len(c) for c in chunks], dtype=np.int64)
        text = "".join(chunks)
        symbols = self.by_character[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)].astype(np.int64)
        owner = np.repeat(np.arange(len(chunks)), sizes)
        lengths = np.ones(len(symbols), dtype=np.int64)
        # The agenda entry of each symbol with its right neighbour; the last symbol of a chunk has none.
        rank, piece = self.find(symbols[:-1], symbols[1:]) if len(symbols) > 1 else (np.empty(0, np.int64), np.empty(0, np.int64))
        rank, piece = np.r_[rank, _NONE][: len(symbols)], np.r_[piece, 0][: len(symbols)]
        rank[:-1][owner[:-1] != owner[1:]] = _NONE
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbols):
            first = np.nonzero(np.r_[True, owner[1:] != owner[:-1]])[0]
            entry = np.where(rank == _NONE, _NONE, (rank << 31) + np.arange(len(rank)))
            best = np.minimum.reduceat(entry, first)
            open_ = best != _NONE
            take = best[open_] & np.int64(0x7FFFFFFF)
            live = np.repeat(open_, np.diff(np.r_[first, len(symbols)]))
            if not open_.all():  # chunks without an entry are done
                done.append((owner[~live], symbols[~live], lengths[~live]))
            symbols[take] = piece[take]
            lengths[take] += lengths[take + 1]
            live[take + 1] = False
            changed = np.zeros(len(symbols), dtype=bool)
            changed[take] = True
            symbols, owner, lengths, rank, piece, changed = (x[live] for x in (symbols, owner, lengths, rank, piece, changed))
            # New entries: each merged symbol with its right neighbour, and its left neighbour with it.
            at = np.nonzero(changed)[0]
            for i in (at, at[at > 0] - 1):
                last = (i + 1 >= len(symbols)) | (owner[np.minimum(i + 1, len(symbols) - 1)] != owner[i])
                rank[i[last]] = _NONE
                i = i[~last]
                rank[i], piece[i] = self.find(symbols[i], symbols[i + 1])
        if not done:
            return [[] for _ in chunks]
        owner, symbols, lengths = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owner, kind="stable")
        symbols, lengths, owner = symbols[order], lengths[order], owner[order]
        odd = np.zeros(len(chunks), dtype=bool)
        odd[owner[symbols >= len(self.pieces)]] = True
        ends = np.cumsum(np.bincount(owner, minlength=len(chunks))).tolist()
        flat, out, at = symbols.tolist(), [], 0
        for end in ends:
            out.append(flat[at:end])
            at = end
        for k in np.nonzero(odd)[0].tolist():
            at = ends[k - 1] if k else 0
            out[k] = self.ids_of(chunks[k], lengths[at : ends[k]].tolist(), out[k])
        return out

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        out: list = [None] * len(chunks)
        short = [i for i, c in enumerate(chunks) if len(c) <= SHORT]
        for i, ids in zip(short, self.encode_short([chunks[i] for i in short]) if short else []):
            out[i] = ids
        return [self.encode_long(chunks[i]) if x is None else x for i, x in enumerate(out)]

    def normalise(self, text: str) -> str:
        return text and (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def blocks(self, text: str) -> Iterator[list[str]]:
        """The chunks of a text, some at a time: each starts with a run of space marks, or is the text's start."""
        text = self.normalise(text)
        if not self.independent:
            yield [text] if text else []
            return
        at = 0
        while at < len(text):
            end = at + BLOCK_CHARS
            if end < len(text):
                # Cut where a space mark follows another character.
                end = next((m.start() + 1 for m in _CUT.finditer(text, end - 1)), len(text))
            yield _CHUNK.findall(text, at, end)
            at = end

    def encode(self, text: str) -> list[int]:
        return [i for block in self.blocks(text) for ids in self.encode_chunks(block) for i in ids]

    def decode_middle(self, ids: list[int]) -> str:
        """Pieces joined, runs of byte pieces read as UTF-8, space marks turned to spaces."""
        text = self.written
        if all(map(text.__contains__, ids)):
            return "".join([text[i] for i in ids])
        out, run = [], bytearray()
        for i in [*ids, -1]:
            if i >= 0 and self.pieces[i][2] == BYTE:
                run.append(int(self.pieces[i][0][1:-1], 16))
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            out.append(text[i] if i in text else " ⁇ " if i == self.unknown else "")
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """As :meth:`decode_middle`, without the space in front that encoding has added."""
        text = self.decode_middle(ids)
        first = next((i for i in ids if self.pieces[i][2] != CONTROL), None)
        return text[1:] if self.prefix and first in self.written and text.startswith(" ") else text


_CUT = re.compile(f"[^{SPACE}](?={SPACE})")
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def _utf8(run: bytes) -> str:
    """Each byte that is not part of a character becomes one replacement character."""
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at : at + n].decode("utf-8"))
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


class Encoder:
    """Encodes whole texts, remembers chunks, and checks each newly encoded chunk against the library."""

    def __init__(self, path: str, check: str = "chunks"):
        import sentencepiece

        self.vocabulary, self.check = Vocabulary(path), check
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.decimal = [str(i) for i in range(len(self.vocabulary.pieces))]
        self.ids: dict[str, str] = {}
        self.texts: dict[str, str] = {}
        self.mended = 0

    def _learn(self, chunks: list[str]) -> None:
        v = self.vocabulary
        own = v.encode_chunks(chunks)
        if self.check == "chunks" and v.independent and v.prefix:
            # Behind its first space mark, which the library adds itself, a chunk is a text.
            at = [i for i, c in enumerate(chunks) if len(c) > 1 and c[0] == SPACE]
            for i, ids in zip(at, self.library.encode([chunks[i][1:].replace(SPACE, " ") for i in at], num_threads=1)):
                if ids != own[i]:
                    self.mended += 1
                    own[i] = ids
        decimal = self.decimal
        for c, ids in zip(chunks, own):
            self.ids[c] = ",".join([decimal[i] for i in ids])
            self.texts[c] = v.decode_middle(ids)

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text) of each text."""
        if len(self.ids) > MEMO_CHUNKS:
            self.ids.clear()
            self.texts.clear()
        out, held, size = [], [], 0
        for t in texts:
            if len(t) >= BLOCK_CHARS:  # a space mark comes in front
                out.extend(self._some(held))
                out.append(self._long(t))
                held, size = [], 0
                continue
            held.append(next(self.vocabulary.blocks(t), []))
            size += len(t)
            if size >= BLOCK_CHARS:
                out.extend(self._some(held))
                held, size = [], 0
        return out + self._some(held)

    def _know(self, chunks: list[str]) -> list[str]:
        missing = [c for c in chunks if c not in self.ids]
        if missing:
            self._learn(list(dict.fromkeys(missing)))
        return [c for c in missing if len(c) > MEMO_CHARS]

    def _forget(self, chunks: list[str]) -> None:
        for c in chunks:
            self.ids.pop(c, None)
            self.texts.pop(c, None)

    def _some(self, texts: list[list[str]]) -> list[tuple[int, str, str]]:
        long = self._know([c for chunks in texts for c in chunks])
        out, drop = [], 1 if self.vocabulary.prefix else 0
        for chunks in texts:
            ids = ",".join(map(self.ids.__getitem__, chunks))
            text = "".join(map(self.texts.__getitem__, chunks))[drop:]
            n = ids.count(",") + 1 if ids else 0
            out.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode("utf-8")).hexdigest()))
        self._forget(long)
        return out

    def _long(self, text: str) -> tuple[int, str, str]:
        """A block at a time."""
        n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
        for chunks in self.vocabulary.blocks(text):
            long = self._know(chunks)
            ids = ",".join(map(self.ids.__getitem__, chunks))
            text = "".join(map(self.texts.__getitem__, chunks))
            ids_hash.update(("," + ids if n else ids).encode())
            text_hash.update((text if n or not self.vocabulary.prefix else text[1:]).encode("utf-8"))
            n += ids.count(",") + 1
            self._forget(long)
        return n, ids_hash.hexdigest(), text_hash.hexdigest()


def encode_documents(docs: DataFrame, model_path: str, check: str = "chunks", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256, mended`` per input row; NULL text counts as empty.

    check: ``chunks`` compares every chunk that a worker encodes with the library, ``texts`` every whole text, ``none``
    nothing.  Where they differ the library's ids are returned, and ``mended`` is true (for all texts of that batch).
    """

    def run(batches):
        encoder = Encoder(model_path, check)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            before = encoder.mended
            rows = encoder.digests(texts)
            if check == "texts":
                for k, (t, ids) in enumerate(zip(texts, encoder.library.encode(texts, num_threads=1))):
                    whole = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(encoder.library.decode(ids).encode()).hexdigest())
                    if rows[k] != whole:
                        encoder.mended += 1
                        rows[k] = whole
            n, ids, text = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string()), pa.array([encoder.mended > before] * len(rows), pa.bool_())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "mended"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, mended boolean").withColumnRenamed("id", id_col)


def encode_ids(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids array<int>, decoded`` per input row: the ids themselves and their text."""

    def run(batches):
        v = Vocabulary(model_path)
        for b in batches:
            ids = [v.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([v.decode(x) for x in ids], pa.string())], names=["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
