"""The join, passages, decontamination and search against brute force."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import decontaminate, jaccard, knn, passages
from millrace.llm import text as T
from tests.llm.conftest import DOCS, corpus, prose

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = SPLIT.findall(lowered(text))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted(((d, len(s), find(d) if d is not None else None) for d, s in sets), key=repr)


def edited(seed):
    """Families of texts near the limit of similarity."""
    pick, rows = random.Random(seed), []
    for family in range(12):
        base = prose(seed * 100 + family, pick.randint(8, 90)).split(" ")
        for _ in range(5):
            own = list(base)
            for _ in range(pick.randint(0, 4)):
                own[pick.randrange(len(own))] = prose(pick.randrange(10**6), 1)
            rows.append((len(rows), " ".join(own[:pick.randint(max(1, len(own) * 3 // 4), len(own))])))
    return rows


def test_words_and_shingles_in_blocks(monkeypatch):
    pick = random.Random(1)
    texts = ["".join(pick.choice("ab \n\tÉxy") for _ in range(pick.randint(0, 200))) for _ in range(80)] + [None, "", " ", "a" * 900]
    data, bounds = T.flat(pa.array(texts))
    whole = T.words(data, bounds)
    monkeypatch.setattr(T, "BLOCK", 64)
    cut = T.words(data, bounds)
    assert (whole.hash == cut.hash).all() and (whole.first == cut.first).all()
    assert [len(whole.of(k)) for k in range(len(texts))] == [len(SPLIT.findall(t or "")) for t in texts]


@pytest.mark.parametrize("rows", [[r[:2] for r in corpus()], edited(1), edited(2)])
def test_join(spark, rows):
    df = spark.createDataFrame([(*r, *[None] * 7) for r in rows], DOCS)
    found = jaccard.joined(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == brute_components(rows)


def test_join_with_a_full_bitmap(spark, monkeypatch):
    """A bitmap that lets nearly every shingle through changes no result."""
    monkeypatch.setattr(jaccard, "MOST_BITS", 8)
    rows = edited(3)
    df = spark.createDataFrame([(*r, *[None] * 7) for r in rows], DOCS)
    found = jaccard.joined(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == brute_components(rows)


def test_join_of_nothing(none):
    assert jaccard.joined(none).count() == 0


def test_compact_windows_cover_every_passage():
    pick = np.random.default_rng(3)
    for least, high in ((3, 1000), (4, 3), (2, 1)):
        values = pick.integers(0, high, 40).astype(np.uint64)
        found = passages.compact_windows(values, least)
        for i in range(len(values)):
            for j in range(i + least - 1, len(values)):
                own = values[i:j + 1]
                assert any(low <= i and j <= r and i <= c <= j and values[c] == own.min() for low, c, r in found)
    assert len(passages.compact_windows(np.zeros(100_000, np.uint64), 46)) < 10_000


def test_passages(spark, docs):
    found = passages.repeated(docs).collect()
    spans = {}
    for r in found:
        spans.setdefault(r.doc_id, []).append((r.start, r.end))
    assert spans[1] == [(0, 120)] and spans[2] == [(0, 120)] and spans[16] == [(0, 120)]
    assert spans[10] == [(40, 100)] and spans[11] == [(30, 90)]
    assert {3, 4} <= set(spans)
    assert not set(spans) & {5, 6, 7, 8, 9, 12, 15, None, *range(100, 120)}
    assert all(r.n_words == r.end - r.start >= 50 and r.other != r.doc_id for r in found)


def test_exact_passages_against_brute_force(spark):
    pick, common = random.Random(5), [prose(900 + k, 70).split(" ") for k in range(4)]
    rows = []
    for k in range(40):
        own = prose(k, pick.randint(0, 60)).split(" ")
        part = common[k % 4][:pick.choice([30, 48, 52, 70])]
        rows.append((k, " ".join(own + part + prose(500 + k, pick.randint(0, 60)).split(" "))))
    runs = {k: {tuple(w[i:i + 50]) for w in [t.split(" ")] for i in range(len(w) - 49)} for k, t in rows}
    want = {a for a in runs for b in runs if a != b and runs[a] & runs[b]}
    df = spark.createDataFrame([(*r, *[None] * 7) for r in rows], DOCS)
    assert want <= {r.doc_id for r in passages.repeated(df).collect()}


def test_passages_of_nothing(none):
    assert passages.repeated(none).count() == 0


def best_edits(item, text):
    before = [0] * (len(text) + 1)
    for x in item:
        now = [before[0] + 1]
        for j, y in enumerate(text, 1):
            now.append(min(before[j - 1] + (x != y), before[j] + 1, now[j - 1] + 1))
        before = now
    return min(before)


def test_decontamination(spark, docs, none):
    pick, items = random.Random(7), [(k, prose(700 + k, 12 + k)) for k in range(6)]
    rows = []
    for k in range(60):
        item = list(items[k % 6][1])
        for _ in range(pick.randint(0, 14)):
            at = pick.randrange(len(item))
            item[at:at + 1] = pick.choice(["", "z", item[at] + "q"])
        rows.append((k, prose(k, pick.randint(0, 20)) + " " + "".join(item).upper() + "  " + prose(k + 99, 3)))
    benchmark = [*items, (6, None), (7, ""), (8, "short"), (0, items[0][1])]
    df = spark.createDataFrame([(*r, *[None] * 7) for r in rows], DOCS)
    bench = spark.createDataFrame([(*b, "x") for b in benchmark], "item_id long, text string, doc_id string")
    found = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.contaminated(df, bench).collect()}
    want = set()
    for doc_id, text in rows:
        for item_id, item in items:
            edits = best_edits(item, decontaminate.folded(text))
            if edits <= decontaminate.edit_budget(len(item)):
                want.add((doc_id, item_id, edits))
    assert found == want and len(want) > 20
    assert decontaminate.contaminated(docs, bench).count() == 0
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


def test_blocks_of_the_benchmark(spark, monkeypatch):
    bench = spark.createDataFrame([(k, prose(k, 30)) for k in range(9)], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "ITEM_CHARS", 400)
    own = list(decontaminate.blocks(bench))
    assert len(own) > 2 and [i for b in own for i in b.ids] == list(range(9))


@pytest.mark.parametrize("scale", [1.0, 1e17])
def test_top_k(spark, monkeypatch, scale):
    monkeypatch.setattr(knn, "SHARD_ROWS", 200)
    monkeypatch.setattr(knn, "QUERY_BLOCK", 3)
    monkeypatch.setattr(knn, "SEED_ROWS", 20)
    monkeypatch.setattr(knn, "LEAF", 16)
    pick = random.Random(4)
    vectors = [(k, [pick.choice([-1, 1]) * pick.random() * scale for _ in range(6)]) for k in range(700)]
    vectors += [(k, vectors[3][1]) for k in range(700, 750)] + [(750, None), (751, [1.0, None]), (752, [float("nan")]),
                                                                 (753, [float("inf")]), (754, []), (755, [0.5]), (None, [1.0])]
    df = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, vector array<double>, score int")
    found = sorted(map(tuple, knn.top_k(df, df.vec_id % 50 == 0).collect()))
    used = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    cut = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    want = []
    for q, x in (u for u in used if u[0] % 50 == 0):
        scores = sorted((-cut(sum(a * b for a, b in zip(x, y))), i) for i, y in used if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert found == sorted(want)
    assert knn.top_k(df.limit(0), df.vec_id % 50 == 0).count() == 0
