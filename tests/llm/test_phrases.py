"""Collocations against plain dictionaries."""

from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import phrases
from tests.llm.conftest import DOCS, corpus


def brute(rows: list[tuple], longest: int, least: int, top: int) -> list[tuple]:
    counts: dict[str, Counter] = {}
    for text, lang in rows:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            w = re.findall(r"[^\x20\x09]+", piece)
            own.update(" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if " " not in p)
        some = {p: a for p, a in f.items() if a >= least and " " in p}
        scored = []
        for p, a in some.items():
            if any(f" {p} " in f" {q} " and p != q and 100 * b >= 80 * a for q, b in some.items()):
                continue
            w = p.split(" ")
            cuts = [(2000000 * a // (f[" ".join(w[:k])] + f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            scored.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        out += [(lang, rank, p.decode(), -a, left, right, n, -score) for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def texts() -> list[tuple]:
    pick, rows = random.Random(3), []
    vocabulary = ["a", "b", "c", "A", "é", "\x1f", "a\x1f", "\x85", "word", "|"]
    for k in range(120):
        words = [pick.choice(vocabulary) for _ in range(pick.randint(0, 40))]
        words += ["new", "york", "city"] * pick.randint(0, 2) + ["x", "y"] * pick.randint(0, 1)
        glue = [pick.choice([" ", " ", " ", "\t ", ". ", "\n", ",", "\x0b"]) for _ in words]
        rows.append(("".join(w + g for w, g in zip(words, glue)), pick.choice(["en", "en", "fr", None, ""])))
    return rows + [(None, "en"), ("", None), ("b " * 30_000, "en"), ("b " * 20, "de"), (" \t\n", "it")]


def found(df, *args, **more) -> list[tuple]:
    return sorted(tuple(r) for r in phrases.collocations(df, *args, **more).drop("k").collect())


@pytest.mark.parametrize("longest, least, top, held", [(4, 3, 2000, 1 << 20), (4, 5, 7, 50), (3, 3, 2000, 1 << 20), (2, 3, 10, 10)])
def test_collocations(spark, longest, least, top, held):
    rows = texts()
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "text string, lang string, n int, phrase string, part string").repartition(3)
    assert found(df, longest, least, top, held=held) == brute(rows, longest, least, top)


def test_a_bitmap_that_lets_all_through(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "text string, lang string")
    assert found(df, 4, 3, 2000, mark_bits=3) == brute(rows, 4, 3, 2000)


def test_shared_corpus_and_empty_table(spark, docs, none):
    rows = [(r[1], r[2]) for r in corpus()]
    assert found(docs, 4, 2, 50) == brute(rows, 4, 2, 50)
    assert found(none) == []
    assert found(spark.createDataFrame([(1, None, None, None, 1, 0.5, "x", 9, 9)], DOCS)) == []


def test_automata_share_beginnings_and_unite():
    words = pa.array(["a b c", "a b d", "a e c", "f b c"])
    shard = phrases.Shard(3)
    list(shard.add(pa.array(["en"] * 4), words, pa.array([1, 2, 3, 4])))
    list(shard.add(pa.array(["en"] * 4), words, pa.array([1, 1, 1, 1])))
    rows = list(shard.flush())
    assert sum(len(b) for r in rows for b in r.column(5).to_pylist()) <= 3 + 1 + 3 + 3
    once = {p: c for r in rows for p, c in zip(phrases.paths(r, 3)[1].to_pylist(), phrases.paths(r, 3)[2].tolist())}
    assert once == {"a b c": 2, "a b d": 3, "a e c": 4, "f b c": 5}


def test_products_beyond_64_bits(spark):
    big = (1 << 62) + 12345
    row = spark.createDataFrame([(big, big, big + 1), (7, 3, 4), (29, 100, 101)], "a long, l long, r long").select(
        "a", "l", "r", phrases.floor_ratio(F.col("a"), F.col("l"), F.col("r"), 2_000_000).alias("s")).collect()
    assert [r.s for r in row] == [2_000_000 * r.a // (r.l + r.r) for r in row]
