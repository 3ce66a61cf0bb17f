"""SimHash near duplicates by a hierarchical index in Gray order (operator 12).

A text's fingerprint has a bit where over half of its 4-word shingles, repeats included, have it in their XXH64. Texts link where at most
``MOST`` = 4 of 64 bits differ. Equal fingerprints are one class, and only distinct ones are searched.

The search works on tiles: four differing bits leave one of five parts of the 64 bits equal, so each fingerprint goes to the five tiles of
its parts' values, and a tile's table is searched alone. Within a tile fingerprints are sorted by Gray rank (the number whose Gray code
they are), which puts patterns that differ in few leading bits side by side. ``Index`` is built on this order: every ``FANOUT`` neighbours get a node
that holds the bits all of them share, and every ``FANOUT`` nodes one above, up to a root; a node keeps only the shared bits that the one above it
doesn't have. A search goes down from the root, adds up the differing bits of the nodes it passes and drops a whole group once they exceed ``MOST``.

A tile of any size is cut into blocks of at most ``BLOCK`` fingerprints, each a row with its own index. Pairs of blocks of a large tile are found by the
same descent, level by level as joins: the nodes above the blocks are rows with the bits shared by all below them. What a pair of blocks
finds is reduced to a spanning forest there, so a group of g near copies gives about g links and never g * g.

Defined results: a null text, or one without words, has fingerprint zero and links like any other. Fewer than four words are one shingle. Rows
without a doc_id stay, and no component is named after them; a component of only such rows has a null id. Repeated rows are equal texts. Very long texts
are hashed in pieces of about ``PIECE`` bytes. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.components import components
from millrace.llm.store import column, saved, slices

SHINGLE = 4
SEED = 42
MOST = 4
PIECE = 1 << 22
#: First bit and width of the parts; one more than the bits that may differ.
PARTS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
FANOUT = 8
BLOCK = 1024
#: Blocks that are searched together, in one index.
TOGETHER = 256
#: Places of the frontier of a search that are looked at together.
FRONTIER = 1 << 20

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_white = re.compile(rb"[\x20\x09-\x0d]")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; a piece ends between words."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        if end < len(text):
            found = _white.search(text, end)
            end = found.start() if found else len(text)
        yield text[at:end].translate(_LOWER).split()
        at = end


def shingle_hashes(text: str | None) -> Iterator[np.ndarray]:
    """XXH64 of each shingle, repeats included."""
    left: list[bytes] = []
    seen = 0
    for words in _words((text or "").encode()):
        words, fresh = left + words, len(words)
        seen += fresh
        if len(words) >= SHINGLE:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.r_[0, ends[:-1] + 1]
            yield np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(
                starts[:len(words) - SHINGLE + 1].tolist(), ends[SHINGLE - 1:].tolist())], np.uint64)
        left = words[-(SHINGLE - 1):]
    if 0 < seen < SHINGLE:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(left), SEED)], np.uint64)


def fingerprint_of(text: str | None) -> int:
    counts, n = np.zeros(64), 0
    for hashes in shingle_hashes(text):
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
        n += len(hashes)
    return sum(1 << k for k in np.flatnonzero(2 * counts > n).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        prints = [_signed(fingerprint_of(t.as_py())) for t in column(batch, "text")]
        yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(prints, pa.int64())], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def gray_rank(code: Column) -> Column:
    """The rank whose Gray code is ``code``, with the top bit flipped so that signed order is its order."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def _runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] of them), first[1], ..."""
    total = np.cumsum(count)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - count, count) + np.repeat(first, count)


class Index:
    """An index over blocks of fingerprints in Gray order; block b holds ``codes[bounds[b]:bounds[b + 1]]``.

    Level 0 is the fingerprints themselves. A level holds of each node the shared bits that the node above doesn't (``mask``), their values
    (``code``) and its children on the level below (``first``, ``count``).
    """

    def __init__(self, codes: np.ndarray, bounds: np.ndarray) -> None:
        everything = np.full(len(codes), np.uint64(0xFFFFFFFFFFFFFFFF))
        ones, any_, size = codes, codes, np.diff(bounds)
        self.levels = [(codes, everything, None, None)]
        while (size > 1).any() or len(self.levels) == 1:
            count = -(-size // FANOUT)
            place = _runs(np.zeros(len(size), np.int64), count)
            first = np.repeat(np.cumsum(size) - size, count) + place * FANOUT
            children = np.minimum(FANOUT, np.repeat(size, count) - place * FANOUT)
            ones, any_ = np.bitwise_and.reduceat(ones, first), np.bitwise_or.reduceat(any_, first)
            shared = ~(ones ^ any_)
            below = self.levels[-1]
            self.levels[-1] = (below[0], below[1] & ~np.repeat(shared, children), *below[2:])
            self.levels.append((ones, shared, first, children))
            size = count

    def near(self, queries: np.ndarray, block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, place in codes) of all that differ in at most MOST bits; query q is searched in block[q] only."""
        top = self.levels[-1]
        sizes = self.sizes()[block]
        done = np.cumsum(sizes)
        at = 0
        while at < len(queries):
            end = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + FRONTIER, "right")))
            q, node = np.arange(at, end), block[at:end]
            differ = np.bitwise_count((queries[q] ^ top[0][node]) & top[1][node])
            for level in range(len(self.levels) - 1, -1, -1):
                keep = differ <= MOST
                q, node, differ = q[keep], node[keep], differ[keep]
                if level:
                    _, _, first, count = self.levels[level]
                    code, mask = self.levels[level - 1][:2]
                    children = _runs(first[node], count[node])
                    q, differ = np.repeat(q, count[node]), np.repeat(differ, count[node])
                    differ = differ + np.bitwise_count((queries[q] ^ code[children]) & mask[children])
                    node = children
            yield q, node
            at = end

    def sizes(self) -> np.ndarray:
        """Fingerprints of each block."""
        size = np.ones(len(self.levels[0][0]), np.int64)
        for _, _, first, _ in self.levels[1:]:
            size = np.add.reduceat(size, first)
        return size


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest number that each of 0, ..., n - 1 reaches by the links."""
    label = np.arange(n)
    for a, b in links:
        while True:
            x, y = label[a], label[b]
            open_ = x != y
            if not open_.any():
                break
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label = label[label]
    return label


def _star(codes: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    own = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(codes[label[own]].view(np.int64)), pa.array(codes[own].view(np.int64))], names=["a", "b"])


def _blocks(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted (tile, code) to blocks of one tile each."""
        own, held = None, np.zeros(0, np.int64)

        def rows(tiles: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
            lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int32), pa.array(np.concatenate(parts)))
            return pa.RecordBatch.from_arrays(
                [pa.array(tiles, pa.int64()), lists, pa.array([int(np.bitwise_and.reduce(p)) for p in parts], pa.int64()),
                 pa.array([int(np.bitwise_or.reduce(p)) for p in parts], pa.int64())], names=["tile", "codes", "ones", "any"])

        for batch in batches:
            tile, code = (column(batch, c).to_numpy() for c in ("tile", "code"))
            edge = np.r_[0, np.flatnonzero(tile[1:] != tile[:-1]) + 1, len(tile)] if len(tile) else np.zeros(1, np.int64)
            tiles, parts = [], []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if own != tile[a]:
                    if len(held):
                        tiles.append(own)
                        parts.append(held)
                    own, held = int(tile[a]), code[a:a]
                held = np.concatenate([held, code[a:b]])
                while len(held) >= size:
                    tiles.append(own)
                    parts.append(held[:size])
                    held = held[size:]
            if tiles:
                yield rows(tiles, parts)
        if len(held):
            yield rows([own], [held])

    return cut


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    found = column(batch, name)
    offsets = found.offsets.to_numpy().astype(np.int64)
    return found.values.to_numpy()[offsets[0]:offsets[-1]].view(np.uint64), offsets - offsets[0]


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, TOGETHER) for batch in batches for at in range(0, batch.num_rows, TOGETHER))


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _portions(batches):
        codes, bounds = _lists(batch, "codes")
        of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        yield _star(codes, forest(len(codes), Index(codes, bounds).near(codes, of)))


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the two blocks of each row."""
    for batch in _portions(batches):
        left, left_bounds = _lists(batch, "left_codes")
        right, right_bounds = _lists(batch, "right_codes")
        of = np.repeat(np.arange(len(left_bounds) - 1), np.diff(left_bounds))
        found = ((q, node + len(left)) for q, node in Index(right, right_bounds).near(left, of))
        yield _star(np.concatenate([left, right]), forest(len(left) + len(right), found))


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """(tile, x, y), x < y: pairs of blocks of one tile that the shared bits don't rule out.

    ``blocks`` has ``block``, the place in the tile. Nodes above the blocks are counted off in groups of FANOUT; a pair of nodes with too
    many differing bits among those both share is dropped with all pairs below it.
    """
    levels, node, width = [], blocks.select("tile", F.col("block").alias("node"), "ones", "any"), blocks.agg(F.max("block")).first()[0] + 1
    while True:
        levels.append(node)
        if width == 1:
            break
        width = -(-width // FANOUT)
        node = saved(node.groupBy("tile", F.floor(F.col("node") / FANOUT).alias("node")).agg(
            F.bit_and("ones").alias("ones"), F.bit_or("any").alias("any")), "block_nodes")
    root = F.lit(0).cast("long")
    pairs = levels[-1].select("tile", root.alias("x"), root.alias("y"))
    for level in levels[-2::-1]:
        side = lambda name: level.select("tile", F.floor(F.col("node") / FANOUT).alias(name), F.col("node").alias(f"{name}_node"),
                                         F.col("ones").alias(f"{name}_ones"), F.col("any").alias(f"{name}_any"))
        both = pairs.join(side("x"), ["tile", "x"]).join(side("y"), ["tile", "y"]).where("x_node <= y_node")
        unshared = F.col("x_ones").bitwiseXOR(F.col("x_any")).bitwiseOR(F.col("y_ones").bitwiseXOR(F.col("y_any")))
        differ = F.bit_count(F.col("x_ones").bitwiseXOR(F.col("y_ones")).bitwiseAND(F.bitwise_not(unshared)))
        pairs = saved(both.where(differ <= MOST).select("tile", F.col("x_node").alias("x"), F.col("y_node").alias("y")), "block_pairs")
    return pairs.where("x < y")


def links(codes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints ``code`` (longs) that connect all within MOST bits of one another."""
    tiles = F.explode(F.array(*[
        (F.shiftrightunsigned("code", low).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(k << 13)).cast("long") for k, (low, width) in enumerate(PARTS)]))
    rank = gray_rank(F.col("code"))
    placed = codes.select("code", tiles.alias("tile")).repartitionByRange("tile", rank).sortWithinPartitions("tile", rank)
    blocks = saved(placed.select("tile", "code").mapInArrow(_blocks(block), "tile long, codes array<long>, ones long, any long"), "blocks")
    within = blocks.select("codes").mapInArrow(_within, "a long, b long")
    # Few tiles have two blocks or more. Those are numbered by their first Gray rank, from the bits alone.
    several = saved(blocks.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("tile"), "large_tiles")
    if several.isEmpty():
        return within
    first = blocks.withColumn("first", F.get("codes", F.lit(0)))
    place = (F.row_number().over(W.partitionBy("tile").orderBy(gray_rank(F.col("first")))) - 1).cast("long")
    places = saved(first.drop("codes").join(several, "tile").withColumn("block", place), "block_places")
    own = first.select("tile", "first", "codes").join(places.select("tile", "first", "block"), ["tile", "first"])
    pairs = _block_pairs(places)
    side = lambda name, place: own.select("tile", F.col("block").alias(place), F.col("codes").alias(name))
    both = pairs.join(side("left_codes", "x"), ["tile", "x"]).join(side("right_codes", "y"), ["tile", "y"])
    return within.unionByName(both.select("left_codes", "right_codes").mapInArrow(_across, "a long, b long"))


def near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable, itself included) and how often its text class occurs."""
    prints = saved(fingerprints(docs), "fingerprints")
    classes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("class_size")), "fingerprint_classes")
    found = components(links(classes.select(F.col("fp").alias("code")), block))
    joined = saved(classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "least", "class_size", F.coalesce("component", "fp").alias("component")), "joined_classes")
    smallest = saved(joined.groupBy("component").agg(F.min("least").alias("component_id")), "component_ids")
    # All sides are plain tables or shuffled anew, so AQE splits the partition of a very common fingerprint or component.
    named = joined.join(smallest, "component").select("fp", "component_id", "class_size")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "class_size")
