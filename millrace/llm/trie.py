"""A trie of conversations by their first turns, rolled up in bands of depths (operator 11).

A node is a distinct sequence of first turns. Its key is a running 128-bit hash of their SHA-256 digests, so texts are hashed once, where they are
read, and never shuffled. Depths are cut into bands of ``BAND``. A node sends its numbers to its ancestors within its own band
only. What a band's top node then holds is complete but for the bands below it; the tops form a trie of their own, ``BAND`` times less deep,
which is rolled up in the same way, and each top's completed total then goes to the ancestors in the band above. So a node is exploded to at
most ``BAND`` rows and the rounds grow with the logarithm of the longest conversation.

Turns are range partitioned by conversation and place, so a conversation may span many tasks: each task goes through its own rows in order, and
takes over the state of the one conversation that the task before left open. Only one such state per task passes the driver.

Defined results: a null role or text is empty. Turns are ordered by turn (null first), then role, the text's first 64 characters and
its digest; repeated rows are turns of their own. Rows without a conv_id belong to no conversation and are left out. Very long texts cost one
pass of SHA-256 in the JVM. An empty table gives no nodes, not even the root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.store import column, saved
from millrace.session import shared_folder

BAND = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

_ALL = (1 << 64) - 1
#: Odd multipliers of the two lanes of a running hash.
_LANES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LANE = ["d0", "d1"]


def turn_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, the columns that order its turns, and each turn's digest (two longs) and code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    half = [F.conv(F.substring("_digest", at, 16), 16, -10).cast("long") for at in (1, 17)]
    return (
        conversations.where("conv_id is not null")
        .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                F.substring(text, 1, 64).alias("begin"), F.char_length(text).cast("long").alias("chars"), digest.alias("_digest"))
        .select("conv_id", "turn", "role", "begin", half[0].alias("d0"), half[1].alias("d1"), "chars")
    )


def _walk(batches: Iterator[pa.RecordBatch], starts: dict[int, tuple]) -> Iterator[tuple]:
    """Sorted batches, each with its conv_ids, the depth of every row and two running hashes up to it."""
    state, begun = None, False
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv, at = column(batch, "conv_id").to_numpy(), np.arange(n)
        if not begun:
            state, begun = starts.get(column(batch, "part")[0].as_py()), True
        new = np.ones(n, np.bool_)
        np.not_equal(conv[1:], conv[:-1], out=new[1:])
        first = np.maximum.accumulate(np.where(new, at, 0))
        depth = at - first + 1
        open_ = (first == 0) & (state is not None and state[0] == conv[0])
        keys = []
        for k, step in enumerate(_LANES):
            power, inverse = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, s, np.uint64)])
                              for s in (step, pow(step, -1, 1 << 64)))
            total = np.r_[np.uint64(0), np.cumsum(column(batch, _LANE[k]).to_numpy().view(np.uint64) * inverse[:n])]
            key = (total[1:] - total[first]) * power[:n]
            if open_.any():
                key[open_] += power[depth[open_]] * np.uint64(state[2 + k])
            keys.append(key)
        if open_.any():
            depth[open_] += state[1]
        state = (int(conv[-1]), int(depth[-1]), int(keys[0][-1]), int(keys[1][-1]))
        yield batch, conv, depth, *keys


def _last_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = part = last = None
    for batch, conv, depth, k0, k1 in _walk(batches, {}):
        if first is None:
            first, part = int(conv[0]), column(batch, "part")[0].as_py()
        last = (int(conv[-1]), int(depth[-1]), str(int(k0[-1])), str(int(k1[-1])))
    if first is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "first", "last", "depth", "k0", "k1"), (part, first, *last)))])


def numbered_turns(rows: DataFrame, order: list[str | Column]) -> DataFrame:
    """``rows`` (conv_id, d0, d1 and others) with ``depth`` (1, 2, ... within the conversation by ``order``) and running hashes ``k0``, ``k1``."""
    shared_folder(rows.sparkSession)
    placed = (rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
              .withColumn("part", F.spark_partition_id()).checkpoint())
    starts, state = {}, None
    states = placed.select("conv_id", *_LANE, "part").mapInArrow(_last_states, "part long, first long, last long, depth long, k0 string, k1 string")
    for row in sorted(states.collect(), key=lambda r: r.part):  # one row per partition
        carried = state if state is not None and state[0] == row.first else None
        if carried:
            starts[row.part] = carried
        own = (row.last, row.depth, int(row.k0), int(row.k1))
        if carried and row.first == row.last:
            grown = [(k + pow(step, own[1], 1 << 64) * c) & _ALL for k, step, c in zip(own[2:], _LANES, carried[2:])]
            own = (own[0], own[1] + carried[1], *grown)
        state = own
    names = [c for c in placed.columns if c != "part"]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, depth, k0, k1 in _walk(batches, starts):
            yield pa.RecordBatch.from_arrays([column(batch, c) for c in names] + [pa.array(depth), pa.array(k0.view(np.int64)), pa.array(k1.view(np.int64))],
                                             names=[*names, "depth", "k0", "k1"])

    kinds = {f.name: f.dataType.simpleString() for f in placed.schema}
    return placed.mapInArrow(numbered, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", depth long, k0 long, k1 long")


def rebuilt(turns: DataFrame, group: int, lent: Column, most: int) -> DataFrame:
    """Conversations whose first turns are those of the first one of their group of ids, as rows of ``numbered_turns`` and the roots.

    ``turns`` are ``turn_digests``. Conversation c takes the first ``lent`` (at most ``most``) turns of the conversation c - c mod
    ``group`` in place of its own first ``lent``. Returned are conv_id, depth, k0, k1, chars, with a row of depth 0 for every conversation.
    """
    own = saved(numbered_turns(turns, [F.col("turn").asc_nulls_first(), "role", "begin", "d0", "d1"])
                .select("conv_id", F.col("depth").alias("place"), "d0", "d1", "chars"), "turns")
    source = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    turn = F.struct("place", "d0", "d1", "chars")
    heads = own.where((source == F.col("conv_id")) & (F.col("place") <= most)).groupBy(F.col("conv_id").alias("head")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"))
    conversations = own.where("place = 1").select("conv_id", source.alias("head"), lent.alias("lent"))
    first = conversations.join(heads, "head").select("conv_id", F.explode(F.slice("turns", F.lit(1), F.col("lent"))).alias("t"))
    rows = first.select("conv_id", F.lit(0).alias("kind"), "t.*").unionByName(
        own.where(F.col("place") > lent).withColumn("kind", F.lit(1)))
    numbered = numbered_turns(rows, ["kind", "place"]).select("conv_id", "depth", "k0", "k1", "chars")
    zero = F.lit(0).cast("long")
    return numbered.unionByName(conversations.select("conv_id", *[zero.alias(c) for c in ("depth", "k0", "k1", "chars")]))


def _bands(rows: DataFrame) -> DataFrame:
    """conv_id, band, path: the nodes of a conversation in a band, and behind them the top of the band below, if there is one. At most BAND + 1."""
    band = F.floor(F.col("depth") / BAND)
    both = F.when((F.col("depth") % BAND == 0) & (F.col("depth") > 0), F.array(band - 1, band)).otherwise(F.array(band))
    return rows.withColumn("band", F.explode(both)).groupBy("conv_id", "band").agg(
        F.sort_array(F.collect_list(F.struct("depth", "k0", "k1", "chars"))).alias("path"))


def _nodes(bands: DataFrame) -> DataFrame:
    """A row per node, with its members, its parent's key and the keys of its ancestors: ``up`` in its band, itself included, and for a band's
    top ``above``, those in the band above."""
    flat = bands.select("conv_id", "band", "path", F.posexplode("path").alias("at", "node"))
    below = F.col("node.depth") == (F.col("band") + 1) * BAND
    keys = F.transform(F.slice("path", F.lit(1), F.col("at") + F.when(below, 0).otherwise(1)), lambda x: F.struct(x["k0"], x["k1"]))
    parent = F.when(F.col("at") > 0, F.get("path", F.col("at") - 1))
    flat = flat.select("conv_id", "node.*", below.alias("below"), keys.alias("keys"), parent["k0"].alias("p0"), parent["k1"].alias("p1"),
                       (F.col("at") + 1 == F.size("path")).alias("last"))
    own = lambda c: F.when(~F.col("below"), c)
    return flat.groupBy("k0", "k1").agg(
        F.min(own(F.col("conv_id"))).alias("conv_id"), F.max("depth").alias("depth"), F.count(own(F.lit(1))).alias("n_convs"),
        F.count(F.when(~F.col("below") & F.col("last"), 1)).alias("n_ends"), F.max("chars").alias("chars"), F.max("p0").alias("p0"),
        F.max("p1").alias("p1"), F.first(own(F.col("keys")), True).alias("up"), F.first(F.when(F.col("below"), F.col("keys")), True).alias("above"))


def _summed(rows: DataFrame, ancestors: str) -> DataFrame:
    return rows.select(F.explode(ancestors).alias("a"), "n_leaves", "saved_tokens").groupBy("a.k0", "a.k1").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def _subtrees(nodes: DataFrame, bands: DataFrame, deepest: int) -> DataFrame:
    """k0, k1 and the sums of n_leaves and saved_tokens over each node's subtree; ``nodes`` hold their own numbers."""
    own = saved(_summed(nodes, "up"), "band_sums")
    if deepest < BAND:
        return own
    top = F.get("path", F.lit(0))
    upper = saved(_bands(bands.select("conv_id", F.col("band").alias("depth"), top["k0"].alias("k0"), top["k1"].alias("k1"),
                                      F.lit(0).cast("long").alias("chars"))), "band_tops")
    tops = _nodes(upper).select("k0", "k1", "up", "above").join(own, ["k0", "k1"])
    whole = _subtrees(saved(tops, "tops"), upper, deepest // BAND)
    passed = _summed(nodes.where("above is not null").select("k0", "k1", "above").join(whole, ["k0", "k1"]), "above")
    return saved(own.unionByName(passed).groupBy("k0", "k1").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")), "subtrees")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (k0, k1, conv_id) to a row per key and batch, with the ids as text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        k0, k1, ids = (column(batch, c).to_numpy() for c in ("k0", "k1", "conv_id"))
        cut = np.flatnonzero(np.r_[True, (k0[1:] != k0[:-1]) | (k1[1:] != k1[:-1])])
        texts, ends = ids.astype(str).tolist(), [*cut[1:].tolist(), len(ids)]
        yield pa.RecordBatch.from_arrays([pa.array(k0[cut]), pa.array(k1[cut]), pa.array(ids[cut]),
                                          pa.array([",".join(texts[a:b]) for a, b in zip(cut.tolist(), ends)])],
                                         names=["k0", "k1", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own, digest = None, None
    done: list[tuple] = []

    def rows() -> pa.RecordBatch:
        k0, k1, texts = zip(*done)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(k0, pa.int64()), pa.array(k1, pa.int64()), pa.array(texts)], names=["k0", "k1", "ends_sha256"])

    for batch in batches:
        for k0, k1, ids in zip(*(column(batch, c).to_pylist() for c in ("k0", "k1", "ids"))):
            if own == (k0, k1):
                digest.update(b"," + ids.encode())
                continue
            if own is not None:
                done.append((*own, digest.hexdigest()))
            own, digest = (k0, k1), hashlib.sha256(ids.encode())
        if done:
            yield rows()
    if own is not None:
        done.append((*own, digest.hexdigest()))
        yield rows()


def _end_digests(bands: DataFrame) -> DataFrame:
    """k0, k1, ends_sha256 of the nodes at which conversations end.

    The ids are sorted and written as text by ranges that may split a node; only the digest itself runs over a node's ids in one task, over
    a text row per range and 10,000 ids, as SHA-256 has no other order.
    """
    last = F.element_at("path", -1)
    ends = bands.where(last["depth"] < (F.col("band") + 1) * BAND).select(last["k0"].alias("k0"), last["k1"].alias("k1"), "conv_id")
    ordered = ends.repartitionByRange("k0", "k1", "conv_id").sortWithinPartitions("k0", "k1", "conv_id")
    listed = ordered.mapInArrow(_listed, "k0 long, k1 long, first long, ids string")
    return listed.repartition("k0", "k1").sortWithinPartitions("k0", "k1", "first").mapInArrow(
        _hashed, "k0 long, k1 long, ends_sha256 string")


def prefix_trie(rows: DataFrame) -> DataFrame:
    """The nodes of conversations given as conv_id, depth, k0, k1, chars (a row of depth 0 each), from the root down.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256; and key, 32 hex digits,
    and parent_key, which identify nodes across calls.
    """
    bands = saved(_bands(rows), "bands")
    deepest = bands.agg(F.max(F.element_at("path", -1)["depth"])).first()[0] or 0
    nodes = saved(
        _nodes(bands).withColumn("n_leaves", (F.col("n_ends") == F.col("n_convs")).cast("long"))
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("chars")), "nodes")
    sums = _subtrees(nodes.select("k0", "k1", "up", "above", "n_leaves", "saved_tokens"), bands, deepest)
    children = nodes.where("p0 is not null").groupBy(F.col("p0").alias("k0"), F.col("p1").alias("k1")).agg(F.count(F.lit(1)).alias("n_children"))
    # A parent may have very many children: both sides are plain tables, so AQE splits its partition.
    parents = nodes.select(F.col("k0").alias("p0"), F.col("k1").alias("p1"), F.col("conv_id").alias("parent_conv_id"))
    hexed = lambda a, b: F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))
    return (
        nodes.select("k0", "k1", "conv_id", "depth", "p0", "p1", "n_convs").join(parents, ["p0", "p1"], "left")
        .join(sums, ["k0", "k1"]).join(children, ["k0", "k1"], "left").join(_end_digests(bands), ["k0", "k1"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
                "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
                hexed("k0", "k1").alias("key"), hexed("p0", "p1").alias("parent_key"))
    )
