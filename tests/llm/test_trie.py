"""The conversation trie against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k0 long, part string"


def brute(rows: list[tuple]) -> set[tuple]:
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        lent = zlib.crc32(str(c).encode()) % 6
        whole = turns.get(c - c % 100, [])[:lent] + own[lent:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ends[tuple(whole)].append(c)
    below = defaultdict(list)
    for node in members:
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    saved = {n: (len(m) - 1) * len(n[-1][1]) if n else 0 for n, m in members.items()}
    return {(min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], sum(not children[b] for b in below[n]),
             sum(saved[b] for b in below[n]), hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
            for n, m in members.items()}


def found(df) -> set[tuple]:
    lent = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    out = trie.prefix_trie(trie.rebuilt(trie.turn_digests(df), 100, lent, 5)).drop("key", "parent_key")
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def conversations() -> list[tuple]:
    """Shared beginnings, one long and hot conversation, copies, nulls, ties, repeated rows and lone or absent heads."""
    pick, rows = random.Random(5), []
    for c in [*range(0, 12), *range(100, 130), *range(205, 215), 300, 301, 399, 401, -7, -100]:
        n = 0 if c == 301 else 90 if c == 7 else 1 if c in (300, 206) else pick.randint(1, 9)
        rows += [(c, t, pick.choice(["user", "assistant", None]), pick.choice(["a", "bb", "", None, "ç" * 70, "ç" * 70 + "x"])) for t in range(n)]
    for c in range(500, 560):  # copies of one conversation
        rows += [(c, t, "user", f"copy {t}") for t in range(40)]
    rows += [(7, None, "user", "first"), (7, None, "user", "first"), (7, 3, "user", "tie"), (7, 3, "user", "tie"), (7, 3, "system", "tie")]
    rows += [(None, 0, "user", "no conversation"), (8, 5, "user", "x" * 200_000), (9, None, None, None)]
    pick.shuffle(rows)
    return [(*r, "x", 9, "y") for r in rows]


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie(spark, monkeypatch, band):
    monkeypatch.setattr(trie, "BAND", band)
    rows = conversations()
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_conversations_over_many_tasks(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "30")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        rows = [(1, t, "user", f"text {t % 7}", "x", 9, "y") for t in range(300)]
        rows += [(c, t, "user", f"text {t % 7}", "x", 9, "y") for c in (0, 2, 3, 104) for t in range(12)]
        assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
        turns = trie.turn_digests(spark.createDataFrame(rows, SCHEMA))
        placed = trie.numbered_turns(turns, ["turn"]).withColumn("task", F.spark_partition_id())
        assert placed.where("conv_id = 1").select("task").distinct().count() > 5
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_no_conversations(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == set()
    assert found(spark.createDataFrame([(None, 0, "user", "a", "x", 1, "y")], SCHEMA)) == set()


def test_one_row_without_turns_left(spark):
    rows = [(c, 0, "user", "only", "x", 1, "y") for c in range(101, 109)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
