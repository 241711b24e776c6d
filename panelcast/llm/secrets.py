"""Secret scans: known forms by pattern, unknown ones by how little a primed compressor can save on them.

A candidate is an unbroken token near a word that speaks of secrets.  Zstandard, primed with a dictionary of common
identifiers, compresses the surrounding text with and without the candidate; the difference is its marginal size.
Words, paths and repeated names cost few bytes; keys cost nearly what they weigh.  Candidates without a digit may be
plain words that the dictionary lacks: pairs of letters, counted in the same identifiers, say what those cost, and the
lower figure is the novelty.  Candidates of high novelty are reported on top of the patterns' spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from string import ascii_lowercase

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Fixed by the contract: the kinds in order, their patterns and least lengths.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")
ASSIGN_CHARS, ACCESS_CHARS = 8, 16
#: Words around which unknown secrets are looked for, and how far around, in characters.
SENSITIVE = ("password", "passwd", "secret", "token", "api_key", "apikey", "credential", "private_key", "auth", "bearer")
CONTEXT = 80
#: Marginal compressed bytes per character from which a candidate is reported, and least characters of a candidate.
NOVELTY, NOVEL_CHARS = 0.85, 16
#: Bits that pairs of letters give a character of a random run, about; what a piece of a name costs besides them, and a
#: character that isn't a letter; and how much the single letters count against the pairs seen.
RANDOM_BITS, PIECE_BITS, LETTER_WEIGHT = 6.0, 2.0, 8.0
#: Common identifiers and code, which a secret is not made of.
IDENTIFIERS = (
    "access_key access_token account address admin api_key apikey application args array assert async auth authorization "
    "await base64 bearer begin boolean bucket build buffer bytes cache callback certificate channel class client client_id "
    "client_secret cluster code column commit config configuration connection console const constructor container content "
    "context cookie count credential credentials data database date debug default define delete description digest directory "
    "document domain double elif else email enable encode encoding endpoint environ environment error event example except "
    "export extends false file filter final float format from function get global group handler hash header headers hidden "
    "host http https identifier import include index info input instance integer interface iterator json key keyword label "
    "lambda language length level library license list load local localhost logger login main manager master message method "
    "model module name namespace network none null number object offset open operator option options output package page "
    "parameter params parent parse passwd password path pattern placeholder port prefix print private private_key process "
    "production profile project property protected protocol provider public public_key query random read record redirect "
    "region register release remote replace repository request require response result return root route sample schema scope "
    "script secret secret_key select self server service session setting signature size source split static status storage "
    "stream string struct subject super switch system table target template test text thread throw time timestamp title token "
    "tokenizer true type undefined update upload uri url user username utf-8 uuid value variable version view void volume "
    "webhook while window worker write yaml your_password_here changeme xxxxxxxx 0123456789 abcdefghijklmnopqrstuvwxyz "
)
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^A-Za-z]")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=~-]{%d,}" % NOVEL_CHARS)
_DIGIT = re.compile("[0-9]")
_NEAR = re.compile("(?ai:" + "|".join(SENSITIVE) + ")")


class Novelty:
    """Marginal compressed bytes against identifiers and the text around; without a digit, also the cost of its letters."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        import zstandard

        self.zstandard, self.identifiers = zstandard, identifiers.encode()
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(self.identifiers, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        words = re.findall("[a-z]+", identifiers.lower())
        pairs = Counter(p for w in words for p in zip("^" + w, w))
        before, letters, n = Counter(), Counter(), pairs.total()
        for (a, b), k in pairs.items():
            before[a] += k
            letters[b] += k
        self.bits = {(a, b): -math.log2((pairs[a, b] + LETTER_WEIGHT * (letters[b] + 1) / (n + 26)) / (before[a] + LETTER_WEIGHT)) for a in "^" + ascii_lowercase for b in ascii_lowercase}

    def letters(self, candidate: str) -> float:
        """Cost of a candidate as pieces of names, per character; a random run has about 1, plain words have less."""
        total = 0.0
        for piece in _PIECES.findall(candidate):
            low = piece.lower() if piece.isalpha() else ""
            total += PIECE_BITS + sum(self.bits[p] for p in zip("^" + low, low))
        return total / len(candidate) / RANDOM_BITS

    def __call__(self, before: str, candidate: str, after: str) -> float:
        """Bytes that the candidate adds to its surroundings, per byte; the cost of its letters if that is less."""
        around, own = (before + " " + after).encode("utf-8"), candidate.encode("utf-8")
        added = (len(self.compressor.compress(around + own)) - len(self.compressor.compress(around))) / len(own)
        return added if _DIGIT.search(candidate) else min(added, self.letters(candidate))


def known_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, each kind leftmost and without overlap."""
    low = text.lower()
    out = []
    if any(w in low for w in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def novel_spans(text: str, known: list[tuple[int, int, int]], novelty: Novelty, least: float = NOVELTY) -> list[tuple[int, int, int]]:
    """Candidates near a sensitive word, apart from known spans, that the compressor can't save on."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE):
        return []
    out, reach, scanned = [], 0, 0
    for near in _NEAR.finditer(text):
        limit = near.end() + CONTEXT
        if limit < reach:
            continue
        # No stretch is read twice: tokens that begin before ``scanned`` have been looked at.
        start = max(reach, scanned, near.start() - CONTEXT)
        # Whole tokens only: one that is cut by the start of the window is read from where it began.
        while max(reach, scanned) < start < len(text) and _is_token(text[start - 1]) and _is_token(text[start]):
            start -= 1
        stop = min(limit + 1, len(text))
        while stop < len(text) and _is_token(text[stop - 1]) and _is_token(text[stop]):
            stop += 1
        scanned = max(scanned, stop)
        for m in _TOKEN.finditer(text, start, stop):
            if m.start() > limit:
                break
            reach = m.end()
            if any(a < m.end() and m.start() < b for a, _, b in known):
                continue
            if novelty(text[max(0, m.start() - CONTEXT) : m.start()], m.group(), text[m.end() : m.end() + CONTEXT]) >= least:
                out.append((m.start(), 3, m.end()))
    return out


def _is_token(c: str) -> bool:
    return c.isascii() and (c.isalnum() or c in "+/_=~-")


def find_spans(text: str, novelty: Novelty) -> list[tuple[int, int, int]]:
    known = known_spans(text)
    return sorted(known + novel_spans(text, known, novelty))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_assign, n_access, n_hex, n_novel, base_sha256, spans`` per input row.

    Spans are in code points, the end exclusive; spans of different kinds may overlap, novel ones never overlap others.
    NULL text counts as empty; repeated rows stay; other columns are ignored.
    """

    def run(batches):
        novelty = Novelty()
        for b in batches:
            found = [find_spans(t or "", novelty) for t in b.column(1).to_pylist()]
            counts = [pa.array([sum(k == kind for _, k, _ in f) for f in found], pa.int64()) for kind in range(4)]
            base = [hashlib.sha256(written([x for x in f if x[1] < 3]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array(base, pa.string()), pa.array([written(f) for f in found], pa.string())], names=["id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = slim.mapInArrow(run, f"id {kind}, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")
    return out.withColumnRenamed("id", id_col)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span, or run of overlapping spans, becomes ``[secret]``."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All rows and columns, with secrets in the text replaced and the character count, if there is one, brought up to date.

    NULL and empty texts stay as they are; repeated rows stay; an empty table gives no rows.
    """
    at = docs.columns.index(text_col)
    counted = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def run(batches):
        novelty = Novelty()
        for b in batches:
            columns = list(b.columns)
            texts, changed = b.column(at).to_pylist(), False
            lengths = columns[counted].to_pylist() if counted is not None else None
            for k, t in enumerate(texts):
                if t and (spans := find_spans(t, novelty)):
                    texts[k], changed = redacted(t, spans), True
                    if lengths is not None:
                        lengths[k] = len(texts[k])
            if changed:
                columns[at] = pa.array(texts, columns[at].type)
                if lengths is not None:
                    columns[counted] = pa.array(lengths, columns[counted].type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)
