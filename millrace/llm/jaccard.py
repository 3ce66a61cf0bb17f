"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures (operator 4).

A document is the set of its 5-word shingles. Documents with equal sets are one class from the start. Two classes whose sets share 75
hundredths of their union must share one of the first quarter of their shingles, if all order them alike (the prefix filter); ours puts
common shingles last. Classes with a prefix shingle in common are a tile. Within a tile only pairs of fitting sizes are compared, first
by bitmap signatures of the width of their size band, whose bits bound the overlap from above, then by the exact intersection
of the sorted shingles of both texts.

So that a group of near copies doesn't cost the square of its size, classes are first linked to the smallest class that shares one of
their min-hashes, and verified; the tiles then compare only classes of different components. No link between different
components is left out, so components are exact.

Defined results: a null or empty text, or one without words, has no shingles and is linked with nothing; fewer than five words are one
shingle. Rows that share an id are one document with the links of all of them; each row is returned. Rows with a null id are linked with
nothing and have a null component. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.components import components
from millrace.llm.store import column, frugal, saved, slices, texts_of
from millrace.llm.text import SIMILAR, flat, mix, shared, shingle_set, similar, words

MIN_HASHES = 4
#: Bins of the count of all shingles. Only the order of shingles depends on them, never a result.
BINS = 1 << 20
PARTS = 16
#: At most so many bits mark the tokens of open tiles: 32 MB.
MOST_BITS = 28
_salts = [np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) & (1 << 64) - 1) for k in range(MIN_HASHES)]


def sets(texts: pa.Array) -> Iterator[np.ndarray]:
    data, bounds = flat(texts)
    own = words(data, bounds)
    for k in range(len(texts)):
        yield shingle_set(own.of(k))


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def signature_words(n: int) -> int:
    """64-bit words of a bitmap for n shingles: from one to two bits for each. A power of two, so it is the size band as well."""
    return max(1, 1 << max(0, (n - 1).bit_length() - 5))


def signature(own: np.ndarray) -> np.ndarray:
    wide = signature_words(len(own))
    at = mix(own) & np.uint64(wide * 64 - 1)
    bits = np.zeros(wide * 64, np.uint8)
    bits[at.astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def overlap_needed(a: Column, b: Column) -> Column:
    """The smallest intersection of similar sets of sizes a and b."""
    part, whole = SIMILAR
    return F.ceil((a + b) * part / (part + whole))


def overlap_bound(size_a: Column, bits_a: Column, size_b: Column, bits_b: Column) -> Column:
    """No less than the size of the intersection: each bit that one signature has alone is an element the other lacks.

    Signatures of neighbouring size bands are compared at the narrower width, the halves of the wider one laid over each other.
    """
    def folded(bits: Column, other: Column) -> Column:
        half = F.size(other)
        return F.when(F.size(bits) > half, F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half),
                                                      lambda x, y: x.bitwiseOR(y))).otherwise(bits)

    def alone(bits: Column, other: Column) -> Column:
        own = F.zip_with(bits, other, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
        return F.aggregate(own, F.lit(0), lambda total, n: total + n)

    narrow_a, narrow_b = folded(bits_a, bits_b), folded(bits_b, bits_a)
    return F.least(size_a - alone(narrow_a, narrow_b), size_b - alone(narrow_b, narrow_a))


def fitting(a: Column, b: Column) -> Column:
    part, whole = SIMILAR
    return F.least(a, b) * whole >= F.greatest(a, b) * part


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text: digest of its set, size, min-hashes. At the end of a task, its counts of all shingles by bin."""
    total = np.zeros(BINS, np.int64)
    for batch in slices(batches, "text"):
        digests, sizes, hashes, every = [], [], [], []
        for own in sets(column(batch, "text")):
            digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            sizes.append(len(own))
            hashes.append([int(mix(own ^ s).min().view(np.int64)) for s in _salts] if len(own) else [])
            every.append(own)
        total += np.bincount((np.concatenate(every) >> np.uint64(44)).astype(np.int64), minlength=BINS)
        none = pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()),
             pa.array(hashes, pa.list_(pa.int64())), *none], names=["doc_id", "digest", "n", "hashes", "part", "counts"])
    if total.any():
        parts = [zlib.compress(p.tobytes(), 1) for p in np.split(total, PARTS)]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(PARTS, pa.int64()), pa.nulls(PARTS, pa.binary()), pa.nulls(PARTS, pa.int32()),
             pa.nulls(PARTS, pa.list_(pa.int64())), pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())],
            names=["doc_id", "digest", "n", "hashes", "part", "counts"])


SCANNED = "doc_id long, digest binary, n int, hashes array<long>, part int, counts binary"


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[part] = total.get(part, 0) + np.frombuffer(zlib.decompress(counts), np.int64)
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(total, pa.int32()), pa.array([zlib.compress(t.tobytes(), 1) for t in total.values()], pa.binary())],
            names=["part", "counts"])


def commonness(scanned: DataFrame) -> np.ndarray:
    """How common each bin of shingles is over all documents, on a scale of 256 steps; a megabyte whatever the corpus."""
    counts = scanned.where("part is not null").select("part", "counts").repartition(PARTS, "part")
    total = np.zeros((PARTS, BINS // PARTS), np.int64)
    for row in counts.mapInArrow(frugal(_sum_counts), "part int, counts binary").collect():
        total[row.part] += np.frombuffer(zlib.decompress(bytes(row.counts)), np.int64)
    return np.minimum(255, np.round(4 * np.log2(total.reshape(-1) + 1))).astype(np.uint8)


def prefix(own: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The shingles of a set that come first in an order all sets share, rare ones before common ones."""
    part, whole = SIMILAR
    rank = common[(own >> np.uint64(44)).astype(np.int64)].astype(np.uint64)
    order = np.argsort(rank << np.uint64(56) | own >> np.uint64(8), kind="stable")
    return own[order[:len(own) - -(-part * len(own) // whole) + 1]]


def _prefixer(common: np.ndarray):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [s for s in sets(column(batch, "text")) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in found], pa.binary()),
                 pa.array([signed(prefix(s, common)) for s in found], pa.list_(pa.int64())),
                 pa.array([signed(signature(s)) for s in found], pa.list_(pa.int64()))], names=["digest", "tokens", "bits"])
    return prefixes


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text_a", "text_b"):
        pairs = zip(sets(column(batch, "text_a")), sets(column(batch, "text_b")))
        yield batch.select(["a", "b"]).filter(pa.array([similar(len(x), len(y), shared(x, y)) for x, y in pairs], pa.bool_()))


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of document ids whose texts are similar, by exact intersection of their shingles; saved."""
    pairs = saved(pairs, "pairs")
    texts = texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    both = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return saved(both.select("a", "b", "text_a", "text_b").mapInArrow(frugal(_verify), "a long, b long").distinct(), "verified")


def starred(classes: DataFrame) -> DataFrame:
    """One pair for each class that shares a min-hash with a smaller class of fitting size: the smallest such class."""
    shares = classes.select("node", "n", F.posexplode("hashes").alias("k", "hash"))
    least = shares.groupBy("k", "hash").agg(F.min(F.struct("node", "n")).alias("least"), F.count(F.lit(1)).alias("many"))
    near = shares.join(least.where("many > 1").drop("many"), ["k", "hash"]).where(
        (F.col("least.node") < F.col("node")) & fitting(F.col("n"), F.col("least.n")))
    return near.groupBy("node").agg(F.min("least.node").alias("a")).select("a", F.col("node").alias("b"))


def _marker(bits: int):
    width = (1 << bits) // PARTS

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy() & ((1 << bits) - 1)
            for part in np.unique(at // width).tolist():
                found.setdefault(part, np.zeros(width, np.bool_))[at[at // width == part] % width] = True
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array([np.packbits(m, bitorder="little").tobytes() for m in found.values()], pa.binary())],
                names=["part", "marks"])
    return marks


def token_marks(tokens: DataFrame) -> np.ndarray:
    """A bitmap with the low bits of all ``tokens`` (token: long) set: eight to sixteen bits for each, ``2**MOST_BITS`` in all at most.

    Every part of it is made in one task and sent once.
    """
    bits = min(MOST_BITS, max(16, (8 * tokens.count()).bit_length()))
    part = F.col("token").bitwiseAND((1 << bits) - 1) / F.lit((1 << bits) // PARTS)
    marks = np.zeros((PARTS, (1 << bits) // PARTS // 8), np.uint8)
    for row in tokens.repartition(PARTS, F.floor(part)).mapInArrow(frugal(_marker(bits)), "part int, marks binary").toLocalIterator():
        marks[row.part] |= np.frombuffer(bytes(row.marks), np.uint8)
    return marks.reshape(-1)


def _marked_tokens(marks: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                lists = column(batch, "tokens")
                tokens, owner = lists.flatten().to_numpy(), pc.list_parent_indices(lists).to_numpy()
                place = np.arange(len(tokens)) - np.searchsorted(owner, owner)
                bit = tokens & (len(marks) * 8 - 1)
                kept = (marks[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(np.bool_)
                own = batch.select(["node", "component", "n"]).take(pa.array(owner[kept]))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(tokens[kept]), pa.array(place[kept], pa.int32())],
                                                       names=["node", "component", "n", "token", "at"])
    return rows


def tile_pairs(prefixes: DataFrame) -> DataFrame:
    """The pairs of classes of different components that share tiles, fit in size and pass two bounds of their overlap.

    Tiles hold ids, sizes and places only. Most prefix shingles are those of one component; a bitmap of the others, of a bounded size,
    drops them before rows are shuffled into tiles, and a join then drops what it let through by chance. A similar pair is met in the
    tile of its first common shingle, from whose place on both sets must be long enough for the overlap: so a tile of a common
    passage, which comes late in most sets, pairs few of them. Signatures go to the pairs that are left, not to every row of every tile.
    """
    every = prefixes.select("component", F.explode("tokens").alias("token"))
    ends = every.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_tiles = saved(ends.where("low < high").select("token"), "open_tiles")
    tokens = prefixes.select("node", "component", "n", "tokens").mapInArrow(
        frugal(_marked_tokens(token_marks(open_tiles))), "node long, component long, n int, token long, at int")
    tiles = saved(tokens.join(open_tiles, "token", "left_semi"), "tiles")
    x, y = (tiles.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "component", "n", "at")]) for s in "xy")
    n_x, n_y = F.col("n_x"), F.col("n_y")
    needed = overlap_needed(n_x, n_y)
    near = x.join(y, "token").where(
        (F.col("node_x") < F.col("node_y")) & (F.col("component_x") != F.col("component_y"))
        & (n_x - F.col("at_x") >= needed) & (n_y - F.col("at_y") >= needed)).select("node_x", "node_y", "n_x", "n_y").distinct()
    x, y = (prefixes.select(*[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "bits")]) for s in "xy")
    signed_pairs = near.join(x, ["node_x", "n_x"]).join(y, ["node_y", "n_y"])
    bound = overlap_bound(n_x, F.col("bits_x"), n_y, F.col("bits_y"))
    return signed_pairs.where(bound >= needed).select(
        F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct()


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id (the smallest id with the same set) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    scanned = saved(docs.mapInArrow(frugal(_scan), SCANNED), "shingles")
    rows = scanned.where("part is null")
    held = rows.where("n > 0 and doc_id is not null")
    classes = saved(held.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"),
                                               F.first("hashes").alias("hashes")), "classes")
    # An id with several texts ties their classes together.
    own = held.select("doc_id", "digest").distinct().join(classes.select("digest", "node"), "digest").select("doc_id", "node")
    ties = own.join(own.groupBy("doc_id").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("many")).where("many > 1"), "doc_id")
    links = verified(docs, starred(classes)).unionByName(ties.select("a", F.col("node").alias("b")))
    early = saved(components(links), "early")
    prefixes = docs.mapInArrow(frugal(_prefixer(commonness(scanned))), "digest binary, tokens array<long>, bits array<long>")
    prefixes = prefixes.groupBy("digest").agg(F.first("tokens").alias("tokens"), F.first("bits").alias("bits"))
    marked = classes.select("digest", "node", "n").join(early, "node", "left").select(
        "digest", "node", "n", F.coalesce("component", "node").alias("component"))
    prefixes = saved(prefixes.join(marked, "digest").drop("digest"), "prefixes")
    links = links.unionByName(verified(docs, tile_pairs(prefixes)))
    found = saved(components(links), "components")
    named = classes.select("digest", "node").join(found, "node", "left").select(
        "digest", F.col("node").alias("class_id"), F.coalesce("component", "node").alias("component"))
    every = rows.join(named, "digest", "left")
    linked = F.col("n") > 0
    return every.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.when(linked, F.col("component")).otherwise(F.col("doc_id"))).alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.when(linked, F.col("class_id")).otherwise(F.col("doc_id"))).alias("class_id"))
