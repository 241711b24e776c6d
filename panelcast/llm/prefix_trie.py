"""Prefix trie of conversations: which share how many of their first turns.

A node stands for a distinct row of first turns.  Turns are hashed with their place, and the sum of the hashes up to a
turn stands for all turns up to it; sums go on from task to task, so a conversation of any length is hashed in parallel.
Conversations are then grouped by blocks of ``BLOCK`` turns: one row per conversation and block meets those of equal
digest, and from there on a row with a count stands for them.  Only where the blocks behind the same turns differ, they
are opened and grouped turn by turn; elsewhere their turns are nodes as they are.

Figures of whole subtrees need no walk: a node is named by its smallest member, nodes of one name form a chain, and a
chain hangs on a node of a smaller name.  Sums over chains go up that much smaller tree by doubling steps, sums along a
chain are running sums, which long chains take tile by tile.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelcast.llm.common import small_or_plain, stored

#: Turns of a block; turns that one task numbers or adds up in a row.
BLOCK, TILE = 4, 4_096
#: Characters of a node's list of ids that travel as one row.
LIST_CHARS = 1 << 16
#: Fixed by the rebuilding rule: conversations of a hundred share a base; 0 to 5 turns come from it.
FAMILY, MOST_SHARED = 100, 6
_HALF = 0xFFFFFFFF


def numbered(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """(``conv, pos, a, b, chars``, ``conv, n``), both written: turns by place from 0, and conversations by length.

    ``a`` and ``b`` are hashes of role and text.  Turns are ordered by number, NULL first, equal numbers by those hashes.
    NULL role or text becomes empty; rows without a conversation's id belong to none and are left out; repeated rows are
    turns of their own.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    role, text = said(role_col), said(text_col)
    slim = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"), F.char_length(text).cast("long").alias("chars")
    )
    slim = stored(slim, "turns")
    sizes = stored(slim.groupBy("conv").agg(F.count("*").alias("n")), "conversations")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    place = F.row_number().over(Window.partitionBy("conv").orderBy(*order[1:])).cast("long") - 1
    names = ["conv", "pos", "a", "b", "chars"]
    long = sizes.where(F.col("n") > tile).select("conv")
    n_long = long.count()
    if not n_long:
        return stored(slim.withColumn("pos", place).select(*names), "numbered"), sizes
    # Longer ones are spread over tasks in their order; each run counts on from those before it.  The last key parts equal rows.
    spread = [*order, F.col("_salt")]
    rows = slim.join(small_or_plain(long, n_long), "conv", "left_semi").withColumn("_salt", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*spread).sortWithinPartitions(*spread).withColumn("at", F.monotonically_increasing_id())
    rows = stored(rows.withColumn("run", F.shiftright("at", 33)), "long-turns")
    runs = rows.groupBy("conv", "run").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs.withColumn("base", F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first")).select("conv", "run", "base"), "runs")
    rows = rows.join(small_or_plain(runs, runs.count()), ["conv", "run"]).withColumn("pos", F.col("base") + F.col("at"))
    short = slim.join(small_or_plain(long, n_long), "conv", "left_anti").withColumn("pos", place)
    return stored(short.select(*names).unionByName(rows.select(*names)), "numbered"), sizes


def rebuilt(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """:func:`numbered` turns of conversations that share beginnings, for measuring the trie.

    Conversation c takes its first h turns from conversation c - c % 100 (h = crc32 of c, modulo 6), then its own behind
    its first h.  The remainder is never negative.
    """
    base = lambda c: F.col(c) - F.pmod(F.col(c), F.lit(FAMILY))
    shared = lambda c: (F.crc32(F.col(c).cast("string").cast("binary")) % MOST_SHARED).cast("long")
    of_base = lambda df: df.where(F.pmod(F.col("conv"), F.lit(FAMILY)) == 0)
    has = of_base(sizes).select(F.col("conv").alias("base"), F.least("n", F.lit(MOST_SHARED)).alias("has"))
    n_bases = has.count()
    own = turns.withColumns({"base": base("conv"), "h": shared("conv")}).where("pos >= h").join(small_or_plain(has, n_bases), "base", "left")
    own = own.withColumn("pos", F.col("pos") - F.col("h") + F.least(F.col("h"), F.coalesce("has", F.lit(0))))
    given = of_base(turns).where(F.col("pos") < MOST_SHARED).withColumnRenamed("conv", "base")
    given = sizes.select("conv", base("conv").alias("base"), shared("conv").alias("h")).where("h > 0").join(small_or_plain(given, n_bases * MOST_SHARED), "base").where("pos < h")
    names = ["conv", "pos", "a", "b", "chars"]
    return stored(own.select(*names).unionByName(given.select(*names)), "rebuilt")


def _key(sums: list[Column], depth: Column) -> list[Column]:
    """128 bits for the first ``depth`` turns, whose hashes have these sums."""
    return [F.xxhash64(*sums, depth), F.xxhash64(depth, *sums, F.lit(7))]


def _running(rows: DataFrame, group: str, place: str, sums: list[str], tile: int, down: bool = False) -> DataFrame:
    """``sums`` added up along ``place`` (``down``: from its end) in each group, the row included; ``rows`` is written.

    A tile is summed by one task; only groups of several tiles need the totals of those before.
    """
    order = F.col(place).desc() if down else F.col(place)
    rows = rows.withColumn("_tile", F.floor(F.col(place) / tile))
    inside = Window.partitionBy(group, "_tile").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumns({s: F.sum(s).over(inside) for s in sums})
    long = stored(rows.where("_tile > 0").select(group).distinct(), "long-groups")
    n_long = long.count()
    if n_long:
        totals = rows.join(small_or_plain(long, n_long), group, "left_semi").groupBy(group, "_tile").agg(*[F.sum(s).alias(s) for s in sums])
        other = Window.partitionBy(group).orderBy(F.col("_tile").desc() if down else F.col("_tile")).rowsBetween(Window.unboundedPreceding, -1)
        totals = stored(totals.select(group, "_tile", *[F.sum(s).over(other).alias(f"{s}_more") for s in sums]), "tiles")
        out = out.join(small_or_plain(totals, totals.count()), [group, "_tile"], "left")
        out = out.withColumns({s: F.col(s) + F.coalesce(F.col(f"{s}_more"), F.lit(0)) for s in sums}).drop(*[f"{s}_more" for s in sums])
    return out.drop("_tile")


def _blocks(turns: DataFrame, tile: int) -> DataFrame:
    """``conv, pos, a, b, chars`` -> a row per conversation and block: keys before it and at each of its turns."""
    parts = {}
    for k, h in enumerate((F.xxhash64("a", "b", "pos"), F.xxhash64("pos", "b", "a", F.lit(3)))):
        parts |= {f"p{2 * k}": h.bitwiseAND(F.lit(_HALF)), f"p{2 * k + 1}": F.shiftrightunsigned(h, 32)}
    names = list(parts)
    hashed = turns.withColumns(parts).withColumns({f"s{k}": F.col(p) for k, p in enumerate(names)})
    summed = _running(hashed, "conv", "pos", [f"s{k}" for k in range(4)], tile)
    key = _key([F.col(f"s{k}") for k in range(4)], F.col("pos") + 1)
    before = _key([F.col(f"s{k}") - F.col(p) for k, p in enumerate(names)], F.col("pos"))
    turn = F.struct(F.col("pos"), key[0].alias("key1"), key[1].alias("key2"), F.col("chars"), before[0].alias("up1"), before[1].alias("up2"))
    blocks = summed.groupBy("conv", F.floor(F.col("pos") / tile).alias("_tile"), F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    last = F.element_at("turns", -1)
    return stored(blocks.select("conv", "block", last.key1.alias("key1"), last.key2.alias("key2"), "turns"), "blocks")


def _nodes(blocks: DataFrame) -> DataFrame:
    """A row per node but the root: ``key1, key2, up1, up2, depth, n, conv, chars``."""
    groups = blocks.groupBy("key1", "key2").agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("turns").alias("turns"))
    first = F.element_at("turns", 1)
    groups = stored(groups.withColumns({"at1": first.up1, "at2": first.up2}), "block-groups")
    forks = stored(groups.groupBy("at1", "at2").agg(F.count("*").alias("ways")).where("ways > 1").select("at1", "at2"), "forks")
    n_forks = forks.count()
    forks = small_or_plain(forks, n_forks)
    opened = lambda df: df.select("n", "conv", F.explode("turns").alias("t")).select("n", "conv", *[F.col(f"t.{c}") for c in ("key1", "key2", "up1", "up2", "chars")], (F.col("t.pos") + 1).alias("depth"))
    straight = opened(groups.join(forks, ["at1", "at2"], "left_anti"))
    same = [F.first(c).alias(c) for c in ("up1", "up2", "chars", "depth")]
    refined = opened(groups.join(forks, ["at1", "at2"], "left_semi")).groupBy("key1", "key2").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), *same)
    return straight.unionByName(refined)


def _lists(batches):
    """Rows sorted by key and id -> parts of the keys' comma-joined ids."""
    at, held, size = None, [], 0
    for b in batches:
        out = []
        for k1, k2, conv in zip(*(b.column(c).to_pylist() for c in ("key1", "key2", "conv"))):
            if at is not None and ((k1, k2) != at[:2] or size >= LIST_CHARS):
                out.append((*at, ",".join(held)))
                at, held, size = None, [], 0
            if at is None:
                at = (k1, k2, conv)
            held.append(str(conv))
            size += len(held[-1]) + 1
        if out:
            yield _list_rows(out)
    if at is not None:
        yield _list_rows([(*at, ",".join(held))])


def _list_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["key1", "key2", "first", "ids"])


def _digests(batches):
    """Parts in order -> digest of the whole list; one part at a time is held."""
    at, digest, out = None, None, []
    for b in batches:
        for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in ("key1", "key2", "ids"))):
            if (k1, k2) == at:
                digest.update(b"," + ids.encode())
                continue
            if at is not None:
                out.append((*at, digest.hexdigest()))
            at, digest = (k1, k2), hashlib.sha256(ids.encode())
        if len(out) >= 1_000:
            yield _digest_rows(out)
            out = []
    if at is not None:
        yield _digest_rows([*out, (*at, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["key1", "key2", "ends_sha256"])


def _ends(blocks: DataFrame, sizes: DataFrame, root: list[Column]) -> DataFrame:
    """``key1, key2, ends_sha256`` of nodes at which conversations end; those without turns end at the root."""
    last = blocks.groupBy("conv").agg(F.max(F.struct("block", "key1", "key2")).alias("l"))
    ends = sizes.select("conv").join(last, "conv", "left").select("conv", *[F.coalesce(F.col(f"l.{k}"), r).alias(k) for k, r in zip(("key1", "key2"), root)])
    ends = ends.repartitionByRange("key1", "key2", "conv").sortWithinPartitions("key1", "key2", "conv")
    parts = ends.mapInArrow(_lists, "key1 long, key2 long, first long, ids string").repartition("key1", "key2").sortWithinPartitions("key1", "key2", "first")
    return parts.mapInArrow(_digests, "key1 long, key2 long, ends_sha256 string")


def _chain_totals(chains: DataFrame) -> DataFrame:
    """``conv, up, leaves, saved`` (a written table) -> sums over each chain and all that hang on it, by doubling."""
    top = chains.where("up IS NULL").select("conv").first()[0]  # the root's chain, one row
    now = chains.select("conv", "up", "leaves", "saved")
    while not (below := now.where("up IS NOT NULL")).isEmpty():
        more = below.groupBy(F.col("up").alias("conv")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        # What hangs on the root's chain has arrived; the others look twice as far up next.
        on = now.select(F.col("conv").alias("up"), F.col("up").alias("next"))
        far = below.where(F.col("up") != top).join(on, "up").select("conv", F.col("next").alias("up"))
        now = now.drop("up").join(more, "conv", "left").join(far, "conv", "left")
        now = stored(now.select("conv", "up", *[(F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("leaves", "l"), ("saved", "s"))]), "chain-sums")
    return now.select("conv", "leaves", "saved")


def trie(turns: DataFrame, sizes: DataFrame, tile: int = TILE) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns`` as :func:`numbered` or :func:`rebuilt` give them, ``sizes`` all conversations, those without turns too.
    ``conv_id`` is a node's smallest member; ``saved_tokens`` counts characters that its subtree needs only once, beyond
    each node's first.  Without conversations there is no row, not even a root.
    """
    zero = F.lit(0).cast("long")
    root = _key([zero] * 4, zero)
    blocks = _blocks(turns, tile)
    whole = sizes.agg(F.count("*").alias("n"), F.min("conv").alias("conv")).where("n > 0")
    none = F.lit(None).cast("long")
    whole = whole.select(root[0].alias("key1"), root[1].alias("key2"), none.alias("up1"), none.alias("up2"), zero.alias("depth"), "n", "conv", zero.alias("chars"))
    nodes = stored(_nodes(blocks).unionByName(whole), "nodes")
    kids = nodes.groupBy(F.col("up1").alias("key1"), F.col("up2").alias("key2")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("key1").alias("up1"), F.col("key2").alias("up2"), F.col("conv").alias("up"))
    named = nodes.join(kids, ["key1", "key2"], "left").join(above, ["up1", "up2"], "left")
    named = named.select("key1", "key2", "depth", "n", "conv", "up", F.coalesce("n_children", zero).alias("n_children"), ((F.col("n") - 1) * F.col("chars")).alias("saved"))
    named = stored(named.withColumn("leaves", (F.col("n_children") == 0).cast("long")), "named-nodes")
    if named.isEmpty():
        chains = named.select("conv", "up", F.col("depth").alias("at"), "leaves", "saved")
        totals = chains.select("conv", "leaves", "saved")
    else:
        hangs = F.when(F.col("up") != F.col("conv"), F.struct("up", (F.col("depth") - 1).alias("at")))
        chains = named.groupBy("conv").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max(hangs).alias("h"))
        chains = stored(chains.select("conv", "leaves", "saved", "h.up", "h.at"), "chains")
        totals = _chain_totals(chains)
    hung = chains.where("up IS NOT NULL").select("conv", "up", "at").join(totals, "conv")
    hung = hung.groupBy(F.col("up").alias("conv"), F.col("at").alias("depth")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    full = named.join(hung, ["conv", "depth"], "left")
    full = stored(full.withColumns({"n_leaves": F.col("leaves") + F.coalesce("l", zero), "saved_tokens": F.col("saved") + F.coalesce("s", zero)}).drop("l", "s", "leaves", "saved"), "hung-nodes")
    out = _running(full, "conv", "depth", ["n_leaves", "saved_tokens"], tile, down=True)
    out = out.join(_ends(blocks, sizes, root), ["key1", "key2"], "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256"))
