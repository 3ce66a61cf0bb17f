"""Fingerprints, the Gray-order index and components against plain loops."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.llm import simhash
from tests.llm.conftest import corpus, prose


def plain_fingerprint(text: str | None) -> int:
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    shingles = [words[k:k + 4] for k in range(len(words) - 3)] if len(words) > 3 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(codes: list[int]) -> dict[int, int]:
    own = {c: c for c in codes}

    def root(c):
        while own[c] != c:
            c = own[c]
        return c

    for a in codes:
        for b in codes:
            if (a ^ b).bit_count() <= 4:
                x, y = root(a), root(b)
                own[max(x, y)] = min(x, y)
    return {c: root(c) for c in codes}


def chained(n: int, seed: int) -> list[int]:
    """Codes that hold dense groups, chains of small steps and lone ones."""
    pick = random.Random(seed)
    out = {0, (1 << 64) - 1, 1 << 63}
    while len(out) < n:
        code = pick.getrandbits(64)
        for _ in range(pick.choice([1, 1, 2, 30])):
            out.add(code)
            for _ in range(pick.choice([1, 3, 4, 5])):
                code ^= 1 << pick.choice([pick.randrange(64), pick.randrange(6)])
    return sorted(out)


@given(st.text("aB \t\n\x0b\x0cé\x1f\x85 .", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def test_long_texts_in_pieces(monkeypatch):
    text = prose(1, 3000) + "\n\n" + " " * 500 + prose(2, 400) + "x" * 900
    whole = plain_fingerprint(text)
    for piece in (7, 64, 1000):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert simhash.fingerprint_of(text) == whole


@pytest.mark.parametrize("fanout", [2, 8])
def test_index_finds_all_pairs(monkeypatch, fanout):
    monkeypatch.setattr(simhash, "FANOUT", fanout)
    monkeypatch.setattr(simhash, "FRONTIER", 500)
    codes = np.array(chained(400, 3), np.uint64)
    ranks = codes.copy()
    for step in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(step)
    codes = codes[np.argsort(ranks)]
    bounds = np.array([0, 1, 1 + 250, len(codes)])
    of = np.repeat(np.arange(3), np.diff(bounds))
    found = {(int(a), int(b)) for x, y in simhash.Index(codes, bounds).near(codes, of) for a, b in zip(x, y)}
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4
    assert found == {(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(near))) if of[a] == of[b]}


def test_gray_rank(spark):
    codes = [0, 1, 5, 77, 1 << 62, -1, -(1 << 63), 123456789012345]
    rows = spark.createDataFrame([(c,) for c in codes], "code long").select("code", simhash.gray_rank(F.col("code")).alias("rank")).collect()
    for r in rows:
        plain = (r.rank + (1 << 63)) % (1 << 64)
        assert plain ^ plain >> 1 == r.code % (1 << 64)


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_links_connect_all(spark, monkeypatch, block):
    codes = chained(150 if block == 1 else 600, 9)
    if block == 3:  # one crowded tile
        codes = sorted(set(codes) | {(0x1234 << 40) ^ (random.Random(k).getrandbits(12)) for k in range(200)})
    signed = [(simhash._signed(c),) for c in codes]
    links = simhash.links(spark.createDataFrame(signed, "code long"), block).collect()
    want = plain_components(codes)
    unsigned = lambda x: x % (1 << 64)
    own = {c: c for c in codes}

    def root(c):
        while own[c] != c:
            c = own[c]
        return c

    for a, b in links:
        assert want[unsigned(a)] == want[unsigned(b)]
        x, y = root(unsigned(a)), root(unsigned(b))
        own[max(x, y)] = min(x, y)
    assert {c: root(c) for c in codes} == want
    assert len(links) <= 5 * len(codes) * (1 if block > 3 else 20)


def test_near_duplicates(spark, docs, none):
    rows = [(r[0], r[1]) for r in corpus()]
    prints = [plain_fingerprint(t) for _, t in rows]
    component = plain_components(sorted(set(prints)))
    least = {}
    for (doc_id, _), code in zip(rows, prints):
        if doc_id is not None:
            least[component[code]] = min(doc_id, least.get(component[code], doc_id))
    want = sorted((d, f"{c:016x}", least.get(component[c]), prints.count(c)) for (d, _), c in zip(rows, prints) if d is not None)
    found = [tuple(r) for r in simhash.near_duplicates(docs, 2).collect()]
    assert sorted(f for f in found if f[0] is not None) == want
    assert len(found) == len(rows)
    assert simhash.near_duplicates(none).count() == 0


def test_hash_is_spark_s_too(spark):
    text = "one two three four"
    row = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t").alias("h")).first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)
