"""Prefix trie: against a walk over every prefix, with long conversations in tiles, and on awkward rows."""

from __future__ import annotations

import random

import brute
import pytest

from panelcast.llm import prefix_trie as pt

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def made(seed: int, conversations: int, most: int, letters: str = "ab"):
    """Few different turns, so many beginnings are shared; some ids and turns have gaps."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * conversations), conversations):
        shift = rng.choice([0, 5])
        rows += [(c, t + shift if t else rng.choice([None, shift]), rng.choice(["user", None]), rng.choice([*letters, "", None])) for t in range(rng.randrange(1, most))]
    rng.shuffle(rows)
    return rows


def nodes(spark, rows, tile=pt.TILE, rebuild=False):
    turns, sizes = pt.numbered(spark.createDataFrame(rows, SCHEMA).repartition(3), tile=tile)
    out = pt.trie(pt.rebuilt(turns, sizes) if rebuild else turns, sizes, tile)
    return sorted((tuple(r) for r in out.select(*NAMES).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, seed):
    rows = made(seed, 60, 12)
    assert nodes(spark, rows) == sorted(brute.trie_rows(brute.ordered_turns(rows)), key=str)


def test_rebuilt(spark):
    rows = made(3, 300, 9, "abcdefgh")
    assert nodes(spark, rows, rebuild=True) == sorted(brute.trie_rows(brute.rebuilt_turns(rows)), key=str)


def test_long_conversations_in_tiles(spark):
    """Tiles of four turns: numbering, digests and sums along chains all go over many tiles."""
    rows = made(4, 12, 60, "a") + [(1_000 + k, t, "user", "same" if t < 50 or k else f"own {t}") for k in range(3) for t in range(70)]
    assert nodes(spark, rows, tile=4) == sorted(brute.trie_rows(brute.ordered_turns(rows)), key=str)


def test_many_levels_of_names(spark):
    """A stair: every conversation leaves the next one a turn later, so chains hang on chains."""
    rows = [(100 - k, t, "user", "same" if t < k else f"own {k}") for k in range(30) for t in range(k + 2)]
    assert nodes(spark, rows) == sorted(brute.trie_rows(brute.ordered_turns(rows)), key=str)


def test_long_lists_of_ids(spark, monkeypatch):
    monkeypatch.setattr(pt, "LIST_CHARS", 10)
    rows = [(k, 0, "user", "x") for k in range(95)] + [(k, 0, "user", "y") for k in range(95, 99)]
    assert nodes(spark, rows) == sorted(brute.trie_rows(brute.ordered_turns(rows)), key=str)


def test_edges(spark):
    """No conversations; only rows without id; repeated rows; conversations that lose all turns; clashing columns."""
    assert nodes(spark, []) == [] and nodes(spark, [(None, 0, "user", "x")]) == []
    twice = [(1, 0, "user", "x"), (1, 0, "user", "x"), (2, 0, "user", "x")]
    assert nodes(spark, twice) == sorted(brute.trie_rows({1: [("user", "x")] * 2, 2: [("user", "x")]}), key=str)
    few = [(c, 0, "user", "x") for c in range(101, 130)]
    assert nodes(spark, few, rebuild=True) == sorted(brute.trie_rows(brute.rebuilt_turns(few)), key=str)
    odd = spark.createDataFrame([(1, 0, "user", "x", 9, 9, "k")], SCHEMA + ", conv long, n int, key1 string")
    assert pt.trie(*pt.numbered(odd)).count() == 2
