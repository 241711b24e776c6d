"""Conversation structure repair: generalised LR parsing over the grammar of roles, with weighted edits.

A conversation is a row of turns; a good one has roles ``(system? (user assistant)+)?``.  A parser for that grammar
reads the turns.  At each turn it may keep it, give it another role, delete it, or insert an empty turn before it, each
at a cost.  All these parses run at once over a graph-structured stack: nodes are parser states with a link to the node
below, parses share what lies below, and parses that end in equal states are merged, the cheapest staying, of equally
cheap ones the one whose edits, written as initials, come first in ASCII.

Why merging by state alone loses nothing here: states with equal tops accept the same continuations, and of two
different lists of edits over the same turns that cost the same, neither begins with the other, so what follows can't
change their order.

A conversation of up to ``SEGMENT`` turns is parsed in one go.  A longer one is cut into segments, which are parsed in
different tasks from every state they may be entered in; a pass over costs and ranks of the segments (a few dozen
numbers each, no text) picks the cheapest chain, and each segment then writes its part of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from panelcast.llm.common import BLANKS, small_or_plain, stored

#: Costs of edits, and of a truncated turn that isn't deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Turns and characters of a conversation that one task holds, and characters of a repaired segment that travel as one row.
SEGMENT, WHOLE_CHARS, PART_CHARS = 4_096, 1 << 24, 1 << 20
ENDINGS = ".!?"
#: The grammar over initials: S is a conversation, P its pairs.
RULES = (("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua"))
INSERTED = {"u": "user", "a": "assistant"}


def lr_table(rules=RULES) -> tuple[dict[tuple[int, str], int], dict[int, tuple[str, int]], frozenset[int]]:
    """LR(0) automaton of a grammar: (state, symbol) -> state; state -> rule to reduce by; states that may end the input.

    The start symbol (that of the first rule) is reduced at the end of the input only, so it needs no state of its own.
    """
    start = rules[0][0]
    heads = {h for h, _ in rules}

    def closed(items: set) -> frozenset:
        todo = list(items)
        while todo:
            r, dot = todo.pop()
            if dot < len(rules[r][1]) and rules[r][1][dot] in heads:
                new = {(k, 0) for k, (h, _) in enumerate(rules) if h == rules[r][1][dot]} - items
                items |= new
                todo += new
        return frozenset(items)

    states = [closed({(k, 0) for k, (h, _) in enumerate(rules) if h == start})]
    goto, reduce, accept = {}, {}, set()
    for at, items in enumerate(states):  # the list grows while it is read
        for symbol in sorted({rules[r][1][d] for r, d in items if d < len(rules[r][1])}):
            target = closed({(r, d + 1) for r, d in items if rules[r][1][d : d + 1] == symbol})
            if target not in states:
                states.append(target)
            goto[at, symbol] = states.index(target)
        for r, d in items:
            if d == len(rules[r][1]):
                if rules[r][0] == start:
                    accept.add(at)
                else:
                    reduce[at] = (rules[r][0], d)
    return goto, reduce, frozenset(accept)


GOTO, REDUCE, ACCEPT = lr_table()


class Node(NamedTuple):
    """The top of a stack: everything read so far, at this cost, by these edits."""

    cost: int
    audit: str
    state: int
    below: Node | None


class Turn(NamedTuple):
    initial: str
    doomed: bool  # blank or repeated: it must go
    truncated: bool


def _stacks() -> dict[int, Node]:
    """For each state that a stack can have on top between two turns, one such stack, without edits."""
    found: dict[int, Node] = {}
    todo, met = [Node(0, "", 0, None)], set()
    while todo:
        node = todo.pop(0)
        if node not in met:  # stacks with equal tops may lead to different ones
            met.add(node)
            found.setdefault(node.state, node)
            todo += [new for symbol in "sua" if (new := shifted(node, symbol, 0, "")) is not None]
    return found


def shifted(node: Node, symbol: str, cost: int, edit: str) -> Node | None:
    """Read a symbol and reduce what is complete; None where the grammar doesn't allow it."""
    state = GOTO.get((node.state, symbol))
    if state is None:
        return None
    cost, audit = node.cost + cost, node.audit + edit
    new = Node(cost, audit, state, node)
    while new.state in REDUCE:
        head, size = REDUCE[new.state]
        base = new
        for _ in range(size):
            base = base.below
        new = Node(cost, audit, GOTO[base.state, head], base)
    return new


def _merge(tops: dict[int, Node], node: Node | None) -> bool:
    """Equal tops become one; did the new one win?"""
    if node is None:
        return False
    held = tops.get(node.state)
    if held is None or node[:2] < held[:2]:
        tops[node.state] = node
        return True
    return False


def with_inserts(tops: dict[int, Node]) -> dict[int, Node]:
    """Before the next turn, or at the end, any empty turns may be inserted."""
    tops, todo = dict(tops), list(tops.values())
    while todo:
        node = todo.pop()
        if tops[node.state] is node:
            todo += [new for symbol in INSERTED if _merge(tops, new := shifted(node, symbol, INSERT, "I"))]
    return tops


def step(tops: dict[int, Node], turn: Turn) -> dict[int, Node]:
    """All parses of one more turn."""
    out: dict[int, Node] = {}
    for node in with_inserts(tops).values():
        _merge(out, Node(node.cost + DELETE, node.audit + "D", node.state, node.below))
        if not turn.doomed:
            price = TRUNCATED if turn.truncated else 0
            if turn.initial:
                _merge(out, shifted(node, turn.initial, price, "K"))
            for symbol in INSERTED:
                _merge(out, shifted(node, symbol, price + REROLE, "R"))
    return out


STACKS = _stacks()


def parse(turns: list[Turn]) -> tuple[int, str]:
    """Cost and edits of the cheapest repair."""
    tops = {0: STACKS[0]}
    for turn in turns:
        tops = step(tops, turn)
    return min(node[:2] for node in with_inserts(tops).values() if node.state in ACCEPT)


def repaired(audit: str, rows: list[tuple[str, str]], after_user: bool = False) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns after the edits; ``after_user``: the turn before them was a user's."""
    left = iter(rows)
    for edit in audit:
        role, text = next(left) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit != "K":
            role = INSERTED["a" if after_user else "u"]
        after_user = role[:1] == "u"
        yield role, text


LEGAL = ("su", "ua", "au")


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows damaged by their key, for measuring the repair.

    The key is crc32 of ``conv:turn`` modulo 20: 0 takes the row away (it stays as a mark, ``gone``), 1 its text, 2 its
    sentence ends, 3 doubles it, 4 makes it a user's.  NULL counts as one space, in the key as in role and text.
    """
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(written(conv_col), F.lit(":"), written(turn_col)).cast("binary")) % 20
    text, role = written(text_col), written(role_col)
    return turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ENDINGS, "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_FIELDS = [f.split()[0] for f in RESULT.split(", ")]


def _faults(rows: DataFrame) -> DataFrame:
    """Adds what the parser sees of each row: initial, blank, truncated, and 128 bits that stand for role and text."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    blank = end == ""
    return rows.withColumns(
        {
            "initial": F.substring("role", 1, 1),
            "blank": blank,
            "truncated": ~blank & ~F.substring(end, -1, 1).isin(*ENDINGS),
            "print": F.concat(F.hex(F.xxhash64("role", "text")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), "text", "role"))),
        }
    )


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("print").asc()]


def _whole_conversations(columns: tuple[str, ...], key: tuple[str, ...] = ("conv_id",)):
    """Sorted batches -> (key, rows) of one group after the other."""

    def rows(batches):
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in columns))

    n = len(key)
    return lambda batches: groupby(rows(batches), key=lambda r: r[:n])


_SEEN = ("conv_id", "turn", "role", "text", "gone", "initial", "blank", "truncated", "print")


def _repair_short(kind: pa.DataType):
    """Sorted rows of whole conversations -> a result row each."""

    def run(batches):
        out: list[tuple] = []
        for (conv,), group in _whole_conversations(_SEEN)(batches):
            seen: set[str] = set()
            numbers, turns, said, counts = [], [], [], [0, 0, 0]
            for _, turn, role, text, gone, initial, blank, truncated, mark in group:
                if gone:
                    continue
                fault = 0 if blank else 1 if mark in seen else 2 if truncated else None
                seen.add(mark)
                if fault is not None:
                    counts[fault] += 1
                numbers.append(turn)
                said.append((role, text))
                turns.append(Turn(initial, fault in (0, 1), fault == 2))
            cost, audit = parse(turns)
            digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired(audit, said)).encode("utf-8"))
            known = {t for t in numbers if t is not None}
            gaps = min(max(known) - min(known) + 1 - len(known), (1 << 63) - 1) if known else 0
            out.append((conv, gaps, *counts, _illegal([t.initial for t in turns]), cost, audit, digest.hexdigest()))
            if len(out) >= 1_000:
                yield _result(out, kind)
                out = []
        if out:
            yield _result(out, kind)

    return run


def _result(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["conv_id", *_FIELDS])


def _segment_summary(kind: pa.DataType):
    """Sorted rows of a segment -> for each state it may be entered in and left in: cost, edits, and the edits' rank among those of the same entry."""
    names = ["conv_id", "segment", "entry", "exit", "cost", "rank", "audit", "first", "final", "illegal"]

    def run(batches):
        for (conv, segment), group in _whole_conversations(("conv_id", "segment", "initial", "fault"), ("conv_id", "segment"))(batches):
            turns = [Turn(i, f in (0, 1), f == 2) for _, _, i, f in group]
            ends = (turns[0].initial, turns[-1].initial, _illegal([t.initial for t in turns]))
            rows = []
            for entry, stack in STACKS.items():
                tops = {entry: stack}
                for turn in turns:
                    tops = step(tops, turn)
                ranked = sorted(tops.values(), key=lambda t: t.audit)
                rows += [(conv, segment, entry, n.state, n.cost, rank, n.audit, *ends) for rank, n in enumerate(ranked)]
            types = [kind, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), *[pa.string()] * 3, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def _cheapest_chain(kind: pa.DataType):
    """Summaries in the order of segments -> the entry and exit each segment has in the cheapest repair, and the inserts at the very end."""
    names = ["conv_id", "segment", "entry", "exit", "end", "cost", "illegal"]

    def run(batches):
        columns = ("conv_id", "segment", "entry", "exit", "cost", "rank", "first", "final", "illegal")
        for (conv,), group in _whole_conversations(columns)(batches):
            tops, back, segments, illegal, last = {0: (0, 0)}, [], [], 0, None
            for segment, rows in groupby(group, key=lambda r: r[1]):
                best: dict[int, tuple] = {}
                for _, _, entry, exit_, cost, rank, first, final, inside in rows:
                    if entry in tops:
                        new = (tops[entry][0] + cost, tops[entry][1], rank, entry)
                        best[exit_] = min(best.get(exit_, new), new)
                illegal += inside + (last is not None and last + first not in LEGAL)
                last = final
                order = sorted(best, key=lambda x: best[x][1:3])
                tops = {x: (best[x][0], order.index(x)) for x in order}
                back.append(bytes(best[x][3] if x in best else 255 for x in range(max(STACKS) + 1)))
                segments.append(segment)
            ends = []
            for state, (cost, rank) in tops.items():
                closed = with_inserts({state: STACKS[state]})
                ends += [(cost + n.cost, rank, n.audit, state) for n in closed.values() if n.state in ACCEPT]
            cost, _, end, state = min(ends)
            rows = []
            for k in range(len(segments) - 1, -1, -1):
                entry = back[k][state]
                rows.append((conv, segments[k], entry, state, end if k == len(segments) - 1 else "", cost, illegal))
                state = entry
                if len(rows) >= 10_000 or k == 0:
                    types = [kind, pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows = []

    return run


def _segment_text(kind: pa.DataType):
    """A segment's edits (the row before its turns) and its turns -> its part of the repaired text, a megabyte a row."""
    names = ["conv_id", "segment", "part", "said"]
    types = [kind, pa.int64(), pa.int32(), pa.string()]

    def run(batches):
        for (conv, segment), group in _whole_conversations(("conv_id", "segment", "audit", "entry", "role", "text"), ("conv_id", "segment"))(batches):
            _, _, audit, entry, _, _ = next(group)
            after_user = (entry, "a") in GOTO
            held, size, part = [], 0, 0
            rows = ((r, t) for *_, r, t in group)
            for role, text in repaired(audit, rows, after_user):
                held.append(f"{role}:{text}\n")
                size += len(held[-1])
                if size >= PART_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((conv, segment, part, "".join(held)), types)], names=names)
                    held, size, part = [], 0, part + 1
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((conv, segment, part, "".join(held)), types)], names=names)

    return run


def _digest_parts(kind: pa.DataType):
    """Parts in order -> digest of the whole without its last line end; one part at a time is held."""

    def run(batches):
        group, digest, open_ = None, None, False
        for b in batches:
            for conv, said in zip(b.column("conv_id").to_pylist(), b.column("said").to_pylist()):
                if group is None or group[0] != conv:
                    if group is not None:
                        yield _digest_row(group[0], digest, kind)
                    group, digest, open_ = (conv,), hashlib.sha256(), False
                if said:
                    digest.update((("\n" if open_ else "") + said[:-1]).encode("utf-8"))
                    open_ = True
        if group is not None:
            yield _digest_row(group[0], digest, kind)

    return run


def _digest_row(conv, digest, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], names=["conv_id", "repaired_sha256"])


def _repair_long(rows: DataFrame, kind: pa.DataType, type_: str, segment: int) -> DataFrame:
    """Conversations of any length: rows are spread over tasks by conversation and turn; ``rows`` has faults marked."""
    # The last key parts rows that are equal in everything, so that no task gets all copies of one.
    spread = rows.where("NOT gone").withColumn("_salt", F.monotonically_increasing_id())
    order = [*_order(), F.col("_salt").asc()]
    spread = spread.repartitionByRange(*order).sortWithinPartitions(*order).drop("_salt")
    at = F.monotonically_increasing_id()
    table = stored(spread.withColumn("at", at).withColumn("segment", F.shiftright("at", 33) * (1 << 33) + F.floor((F.col("at") % (1 << 33)) / segment)), "long-turns")
    # Repeated turns: known by where the first of them stands.
    first = table.groupBy("conv_id", "print").agg(F.min("at").alias("first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    first = stored(first, "long-repeats")
    slim = table.select("conv_id", "segment", "at", "turn", "initial", "blank", "truncated", "print").alias("t")
    first = small_or_plain(first, first.count()).alias("f")
    marked = slim.join(first, F.col("t.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("t.print") == F.col("f.print")), "left").select("t.*", "first")
    fault = F.when(F.col("blank"), 0).when(F.col("first") < F.col("at"), 1).when(F.col("truncated"), 2)
    marked = stored(marked.select("conv_id", "segment", "at", "turn", "initial", fault.alias("fault")), "long-faults")
    counted = marked.groupBy("conv_id").agg(*[F.sum((F.col("fault") == k).cast("long")).alias(n) for k, n in enumerate(("blank", "duplicate", "truncated"))])
    by_turn = marked.where("turn IS NOT NULL").select("conv_id", "turn").distinct()
    span = by_turn.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    summary = marked.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "at")
    summary = summary.mapInArrow(_segment_summary(kind), f"conv_id {type_}, segment long, entry int, exit int, cost long, rank int, audit string, first string, final string, illegal long")
    summary = stored(summary, "long-segments")
    chain = summary.drop("audit").repartition("conv_id").sortWithinPartitions("conv_id", "segment", "entry", "exit")
    chain = stored(chain.mapInArrow(_cheapest_chain(kind), f"conv_id {type_}, segment long, entry int, exit int, end string, cost long, illegal long"), "long-chain")
    same = [F.col("s.conv_id").eqNullSafe(F.col("c.conv_id")), *(F.col(f"s.{k}") == F.col(f"c.{k}") for k in ("segment", "entry", "exit"))]
    edits = summary.alias("s").join(chain.alias("c"), same).select("s.conv_id", "s.segment", "s.entry", F.concat("audit", "end").alias("audit"), "c.cost", "c.illegal")
    edits = stored(edits, "long-edits")
    # The audit is one value of a result row by definition, so its parts come together here: one byte a turn.
    parts = F.array_sort(F.collect_list(F.struct("segment", "audit")))
    audit = edits.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p.audit), "").alias("audit"), F.first("cost").alias("cost"), F.first("illegal").alias("illegal"))
    head = edits.select("conv_id", "segment", F.lit(-1).cast("long").alias("at"), "audit", "entry", F.lit("").alias("role"), F.lit("").alias("text"))
    told = table.select("conv_id", "segment", "at", F.lit("").alias("audit"), F.lit(0).alias("entry"), "role", "text")
    said = head.unionByName(told).repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "at")
    said = said.mapInArrow(_segment_text(kind), f"conv_id {type_}, segment long, part int, said string")
    digest = said.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "part")
    digest = digest.mapInArrow(_digest_parts(kind), f"conv_id {type_}, repaired_sha256 string")
    out = counted
    for more in (span, audit, digest):
        match = F.col("l.conv_id").eqNullSafe(F.col("r.conv_id"))
        out = out.alias("l").join(more.alias("r"), match, "left").select("l.*", *[f"r.{c}" for c in more.columns if c != "conv_id"])
    return out.select("conv_id", *[F.coalesce(f, F.lit(0)).alias(f) if f in ("gaps", "blank", "duplicate", "truncated") else F.col(f) for f in _FIELDS])


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone_col: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation: ``conv_col``, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns are ordered by number, NULL first; equal numbers by a hash of role and text.  NULL role or text counts as one
    space; a role that is empty can't be kept.  NULL ``conv_col`` is a conversation like another.  Rows marked by
    ``gone_col`` count for nothing, but their conversation has its result.  Repeated rows are faults, not dropped before.
    Roles and texts are equal if two 64-bit hashes of them are.  Other columns are ignored; an empty table gives no rows.
    """
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    gone = F.coalesce(F.col(gone_col), F.lit(False)) if gone_col else F.lit(False)
    slim = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), as_text(role_col).alias("role"), as_text(text_col).alias("text"), gone.alias("gone"))
    type_ = slim.schema["conv_id"].dataType.simpleString()
    kind = to_arrow_type(slim.schema["conv_id"].dataType)
    there = F.when(~F.col("gone"), F.char_length("text"))
    sizes = slim.groupBy(F.col("conv_id").alias("_conv")).agg(F.count(there).alias("_size"), F.sum(there).alias("_chars"))
    long = stored(sizes.where((F.col("_size") > segment) | (F.col("_chars") > WHOLE_CHARS)).select("_conv"), "long-conversations")
    n_long = long.count()
    rows = _faults(slim)
    if n_long:
        match = F.col("conv_id").eqNullSafe(F.col("_conv"))
        short = rows.join(small_or_plain(long, n_long), match, "left_anti")
    else:
        short = rows
    dealt = short.repartition("conv_id").sortWithinPartitions(*_order())
    out = dealt.select(*_SEEN).mapInArrow(_repair_short(kind), f"conv_id {type_}, {RESULT}")
    if n_long:
        out = out.unionByName(_repair_long(rows.join(small_or_plain(long, n_long), match, "left_semi"), kind, type_, segment))
    return out.withColumnRenamed("conv_id", conv_col) if conv_col != "conv_id" else out

