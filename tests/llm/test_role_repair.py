"""Conversation repair: the parser against a plain search, the query against it, long conversations in segments."""

from __future__ import annotations

import random

import brute
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from panelcast.llm import role_repair as rr

NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=str)


def test_automaton():
    assert len(rr.STACKS) == 6 and len(rr.ACCEPT) == 3 and set(rr.STACKS) >= rr.ACCEPT


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["u", "a", "s", "x", ""]), st.sampled_from([(False, False), (False, False), (True, False), (False, True)])), max_size=9))
def test_parser_finds_the_cheapest_edits(turns):
    turns = [(i, *f) for i, f in turns]
    assert rr.parse([rr.Turn(*t) for t in turns]) == brute.cheapest_edits(tuple(turns))


def made(seed: int, conversations: int, most: int):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(most)):
            role = rng.choice(["user", "assistant", "system", "tool", "user", "assistant", "", None])
            rows.append((c if c else None, rng.choice([t, t, t, 3 * t]), role, rng.choice(["Hello there.", "So?", "cut off", " \n", "", None, "Well!", "x. y", f"Turn {t} of {c}."])))
    # Equal turns would stand in an order of their own; the plain version has none.
    seen = set()
    return [r for r in rows if not ((r[0], r[1]) in seen or seen.add((r[0], r[1])))] + [(7_000, None, "user", "No number.")]


def test_repair_equals_the_plain_version(spark):
    rows = made(3, 60, 12)
    got = rows_of(rr.repair(rr.damaged(spark.createDataFrame(rows, SCHEMA).repartition(3)), gone_col="gone"))
    assert got == sorted(brute.role_repairs(rows), key=str)


def test_segments_give_the_same(spark):
    """With segments of four turns nearly every conversation takes the way of long ones."""
    rows = made(4, 40, 40)
    frame = rr.damaged(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert rows_of(rr.repair(frame, gone_col="gone", segment=4)) == sorted(brute.role_repairs(rows), key=str)


def test_long_texts_take_the_long_way(spark, monkeypatch):
    monkeypatch.setattr(rr, "WHOLE_CHARS", 40)
    monkeypatch.setattr(rr, "PART_CHARS", 8)
    rows = made(5, 20, 9)
    assert rows_of(rr.repair(rr.damaged(spark.createDataFrame(rows, SCHEMA)), gone_col="gone")) == sorted(brute.role_repairs(rows), key=str)


def test_edges(spark):
    """Empty table, only marks, repeated rows, extra columns with the operator's own names."""
    schema = SCHEMA + ", print string, segment int, gone boolean, blank string"
    assert rr.repair(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, 0, "user", "Hi.", "p", 1, True, "b"), (2, 0, "user", "Hi.", "p", 1, None, "b"), (2, 0, "user", "Hi.", "p", 1, False, "b"), (2, 1, "assistant", "Yes.", None, None, None, None)]
    got = rows_of(rr.repair(spark.createDataFrame(rows, schema), gone_col="gone"))
    assert got == [(1, 0, 0, 0, 0, 0, 0, "", brute.sha("")), (2, 0, 0, 1, 0, 1, 2, "KDK", brute.sha("user:Hi.\nassistant:Yes."))]
    kept = rr.repair(spark.createDataFrame(rows, schema).withColumnRenamed("conv_id", "Thread"), conv_col="Thread", segment=1)
    assert sorted((r.Thread, r.audit) for r in kept.collect()) == [(1, "D"), (2, "KDK")]


@pytest.mark.parametrize("kinds", [range(20)])
def test_damage(spark, kinds):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(20) for t in range(5)] + [(None, None, None, None)]
    got = rr.damaged(spark.createDataFrame(rows, SCHEMA)).where(~F.col("gone")).select("conv_id", "turn", "role", "text").collect()
    want = [(c, *t) for c, turns in brute.damaged_turns(rows).items() for t in turns]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
