"""Phrases of words that stand together more often than their parts, counted by weighted acyclic automata (operator 13).

A task sorts the n-grams of its shard and builds a count transducer from them, row by row in sorted order: a state is a distinct beginning, it is made
where an n-gram leaves the path of the one before, and the state of the last word weighs the n-gram's count. An automaton is stored as its
states in preorder (label, depth, weight), cut at prefix ranges: n-grams of one range share a hash of their first n - 1 words. A range's automata from all shards
meet in one task, which unites them and sums their weights. The counts of a phrase's parts are looked up by composing an automaton of
the parts asked for with the united one of the same range.

Only n-grams that occur ``least`` times matter, and so do all their parts. So words are counted first, then pairs of frequent words, then longer n-grams
whose pairs are all frequent. What is frequent is passed on as a bitmap of ``1 << mark_bits`` bits, whatever the size of the corpus; an
n-gram that it lets through by chance is counted like any other and dropped by its count, so counts and results are exact.

Bounds: a shard is sent on as soon as it holds ``held`` distinct n-grams. A range holds what begins with one hash of n - 1 words, of which each is
followed by frequent words only, so its size is bounded by their number and not by how often anything occurs.

Defined results: a null text is empty, a null language is ``und``. Repeated rows count again. Very long texts are rows of their own in a task and counted
whole. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.store import column, saved, slices
from millrace.llm.text import LOWER, SAME, flat, mix, runs_of, words

#: Bytes that end a piece, and those that part words within one.
STOPS = np.zeros(256, np.int32)
STOPS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 1
KINDS = np.ones(256, np.uint8)
KINDS[[0x20, 0x09, *np.flatnonzero(STOPS)]] = 0
HELD = 1 << 18
GATHERED = 1 << 19
#: Bytes of text, and of stored labels, that are handled at once.
TEXT, LABELS = 1 << 21, 1 << 20
RANGE_BITS = 12
MARK_BITS = 26

PIECES = "lang string, n int, range int, asked boolean, labels binary, depths binary, weights binary, total long"
_steps = np.random.Generator(np.random.PCG64(13)).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] of them), first[1], ..."""
    total = np.cumsum(count)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - count, count) + np.repeat(first, count)


def _cut(data: np.ndarray, start: np.ndarray, end: np.ndarray, between: int, after: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of words data[start:end] (2-d) as bytes with ``between`` them and ``after`` each row, and the rows' offsets. ``data`` has a byte to spare.

    The bytes are gathered some ``GATHERED`` at a time, as each takes several numbers of eight bytes on the way.
    """
    size = end - start + 1
    if after is None:
        size[:, -1] -= 1
    offsets = np.r_[0, np.cumsum(size.sum(axis=1))]
    out, at = np.empty(int(offsets[-1]), np.uint8), 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + GATHERED, "right")) - 1)
        part, count = out[offsets[at]:offsets[to]], size[at:to]
        part[:] = data[_runs(start[at:to].ravel(), count.ravel())]
        stop = np.cumsum(count.ravel()).reshape(count.shape)
        part[stop[:, :-1].ravel() - 1] = between
        if after is not None:
            part[stop[:, -1] - 1] = after
        at = to
    return out, offsets.astype(np.int32)


def _array(kind: pa.DataType, data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int32)[array.offset:array.offset + len(array) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return every[bounds[0]:bounds[-1]], (bounds - bounds[0]).astype(np.int64)


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x.encode()) for x in langs], np.uint64)


def _marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys >> np.uint64(64 - (8 * len(marks)).bit_length() + 1)).astype(np.int64)
    return (marks[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(np.bool_)


def automata(lang: list[str], phrases: pa.Array, counts: np.ndarray, n: int, asked: bool = False) -> Iterator[pa.RecordBatch]:
    """Distinct phrases of n words, space-joined, as automata: a row for each language and prefix range."""
    if not len(phrases):
        return
    data, bounds = flat(phrases)
    found = words(data, bounds, KINDS, SAME)
    hashes = found.hash.reshape(-1, n)
    prefix = mix((hashes[:, :max(1, n - 1)] * _steps[:max(1, n - 1)]).sum(axis=1, dtype=np.uint64))
    part = (prefix >> np.uint64(64 - RANGE_BITS)).astype(np.int32)
    table = pa.table({"lang": lang, "part": part, "phrase": phrases})
    order = pc.sort_indices(table, [("lang", "ascending"), ("part", "ascending"), ("phrase", "ascending")]).to_numpy()
    hashes, counts, part, lang = hashes[order], counts[order], part[order], table["lang"].take(pa.array(order)).combine_chunks()
    codes = lang.dictionary_encode().indices.to_numpy()
    cut = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (codes[1:] != codes[:-1])])
    new = np.ones(hashes.shape, np.bool_)
    new[1:] = ~np.logical_and.accumulate(hashes[1:] == hashes[:-1], axis=1)
    new[cut] = True
    row, depth = np.nonzero(new)
    start, end = found.start.reshape(-1, n)[order], found.end.reshape(-1, n)[order]
    labels, at = _cut(np.r_[data, np.uint8(0)], start[row, depth][:, None], end[row, depth][:, None], 0x20, 0x0A)
    states = np.r_[0, np.cumsum(new.sum(axis=1))][np.r_[cut, len(new)]]
    weights = np.where(depth == n - 1, counts[row], 0).astype("<i8")
    k = len(cut)
    yield pa.RecordBatch.from_arrays([
        lang.take(pa.array(cut)), pa.array(np.full(k, n, np.int32)), pa.array(part[cut]), pa.array(np.full(k, asked)),
        _array(pa.binary(), labels, at[states]), _array(pa.binary(), depth.astype(np.uint8), states),
        _array(pa.binary(), weights.view(np.uint8), states * 8), pa.array(np.zeros(k, np.int64))],
        names=["lang", "n", "range", "asked", "labels", "depths", "weights", "total"])


def paths(rows: pa.RecordBatch, n: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The row, the phrase and the weight of each path of n words through the automata of ``rows``."""
    labels, _ = _bytes(column(rows, "labels"))
    depth, of = _bytes(column(rows, "depths"))
    weights = _bytes(column(rows, "weights"))[0].copy().view("<i8")
    end = np.flatnonzero(labels == 0x0A)
    start = np.r_[0, end[:-1] + 1][:len(end)]
    at, last = np.arange(len(depth)), depth == n - 1
    state = np.stack([np.maximum.accumulate(np.where(depth == d, at, 0))[last] for d in range(n)], axis=1)
    data, offsets = _cut(labels, start[state], end[state], 0x20)
    return np.repeat(np.arange(len(of) - 1), np.diff(of))[last], _array(pa.string(), data, offsets), weights[last]


class Shard:
    """Counts of phrases of n words, sent on as automata whenever there are many."""

    def __init__(self, n: int, asked: bool = False, held: int = HELD) -> None:
        self.n, self.asked, self.held, self.parts, self.rows = n, asked, held, [], 0

    def add(self, langs: pa.Array, phrases: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(pa.table({"lang": langs, "phrase": phrases, "count": counts}))
        self.rows += len(phrases)
        if self.rows > self.held:
            self._join()
            if self.rows > self.held // 2:
                yield from self.flush()

    def _join(self) -> None:
        table = pa.concat_tables(self.parts).group_by(["lang", "phrase"]).aggregate([("count", "sum")])
        self.parts, self.rows = [table.rename_columns(["lang", "phrase", "count"])], len(table)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            self._join()
            table = self.parts[0].combine_chunks()
            yield from automata(table["lang"], table["phrase"].combine_chunks(), table["count"].to_numpy(), self.n, self.asked)
        self.parts, self.rows = [], 0


def _counted(sizes: list[int], marks: np.ndarray | None, held: int) -> Callable:
    """The n-grams of texts; with ``marks`` those alone whose parts of sizes[0] - 1 words are all marked."""
    known = sizes[0] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {n: Shard(n, held=held) for n in sizes}
        for batch in slices(batches, "text", most=TEXT):
            data, bounds = flat(column(batch, "text"))
            data = np.r_[LOWER[data], np.uint8(0)]
            found = words(data[:-1], bounds, KINDS, SAME)
            if not len(found.hash):
                continue
            langs = column(batch, "lang").dictionary_encode()
            text = np.repeat(np.arange(len(bounds) - 1), np.diff(found.first))
            lang = langs.indices.to_numpy()[text]
            salt = _lang_hashes(langs.dictionary.to_pylist())[lang]
            stops = np.cumsum(STOPS[data], dtype=np.int32)[found.start]
            run_of = np.r_[0, np.cumsum((stops[1:] != stops[:-1]) | (text[1:] != text[:-1]))]
            fine = None if marks is None else _marked(marks, mix(runs_of(found.hash, known) + salt[:max(0, len(salt) - known + 1)]))
            for n, shard in shards.items():
                m = len(found.hash) - n + 1
                if m <= 0:
                    continue
                kept = run_of[:m] == run_of[n - 1:]
                for k in range(n - known + 1 if marks is not None else 0):
                    kept &= fine[k:k + m]
                at = np.flatnonzero(kept)
                if not len(at):
                    continue
                _, first, count = np.unique(mix(runs_of(found.hash, n)[at] + salt[at]), return_index=True, return_counts=True)
                at = at[first]
                place = at[:, None] + np.arange(n)
                phrases = _array(pa.string(), *_cut(data, found.start[place], found.end[place], 0x20))
                yield from shard.add(langs.dictionary.take(pa.array(lang[at])), phrases, count)
        for shard in shards.values():
            yield from shard.flush()

    return run


def _merged(batches: Iterator[pa.RecordBatch], held: int = HELD) -> Iterator[tuple[str, int, pa.Table]]:
    """Automata sorted by (lang, n, range), united: (lang, n) and a table phrase, count, asked of ranges that are complete."""
    parts, keys, rows, last, most = [], [], 0, None, held

    def united(done_before: int | None) -> Iterator[tuple[str, int, pa.Table]]:
        nonlocal parts, rows, most
        if not parts:
            return
        table = pa.concat_tables(parts).group_by(["key", "phrase"]).aggregate([("count", "sum"), ("asked", "sum")]).rename_columns(
            ["key", "phrase", "count", "asked"])
        rest = table.filter(pc.equal(table["key"], done_before)) if done_before is not None else table.slice(0, 0)
        done = table if done_before is None else table.filter(pc.not_equal(table["key"], done_before))
        groups: dict[tuple, list[int]] = {}
        for key in pc.unique(done["key"]).to_pylist():
            groups.setdefault(keys[key][:2], []).append(key)
        for (lang, n), own in groups.items():
            yield lang, n, done.filter(pc.is_in(done["key"], pa.array(own, pa.int64())))
        parts, rows, most = [rest], len(rest), max(held, 2 * len(rest))

    for batch in slices(batches, "labels", most=LABELS):
        row_keys = []
        for key in zip(*(column(batch, c).to_pylist() for c in ("lang", "n", "range"))):
            if key != last:
                keys.append(key)
                last = key
            row_keys.append(len(keys) - 1)
        row_keys, n_of = np.array(row_keys), column(batch, "n").to_numpy()
        asked = column(batch, "asked").to_numpy(zero_copy_only=False)
        for n in np.unique(n_of).tolist():
            own = np.flatnonzero(n_of == n)
            row, phrases, weights = paths(batch.take(pa.array(own)), n)
            ask = asked[own][row]
            parts.append(pa.table({"key": row_keys[own][row], "phrase": phrases, "count": np.where(ask, 0, weights), "asked": np.where(ask, 1, 0)}))
            rows += len(row)
        if rows > most:
            yield from united(len(keys) - 1)
    yield from united(None)


def _united(least: int, held: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, int] = {}
        for lang, n, table in _merged(batches, held):
            totals[lang, n] = totals.get((lang, n), 0) + (pc.sum(table["count"]).as_py() or 0)
            table = table.filter(pc.greater_equal(table["count"], least)).combine_chunks()
            if len(table):
                yield from automata([lang] * len(table), table["phrase"].combine_chunks(), table["count"].to_numpy(), n)
        if totals:
            yield pa.RecordBatch.from_pylist(
                [{"lang": lang, "n": n, "range": -1, "asked": False, "labels": b"", "depths": b"", "weights": b"", "total": total}
                 for (lang, n), total in totals.items()],
                pa.schema([("lang", pa.string()), ("n", pa.int32()), ("range", pa.int32()), ("asked", pa.bool_()), ("labels", pa.binary()),
                           ("depths", pa.binary()), ("weights", pa.binary()), ("total", pa.int64())]))

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, _, table in _merged(batches):
        table = table.filter(pc.greater(table["asked"], 0)).combine_chunks()
        if len(table):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(table)), table["phrase"].combine_chunks(), table["count"].combine_chunks()],
                                             names=["lang", "part", "f"])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shards: dict[int, Shard] = {}
    for batch in batches:
        n_of = column(batch, "n").to_numpy()
        for n in np.unique(n_of).tolist():
            own = pa.array(np.flatnonzero(n_of == n))
            yield from shards.setdefault(n, Shard(n, True)).add(column(batch, "lang").take(own), column(batch, "part").take(own), np.ones(len(own), np.int64))
    for shard in shards.values():
        yield from shard.flush()


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "labels", most=LABELS):
        n_of = column(batch, "n").to_numpy()
        for n in np.unique(n_of).tolist():
            own = batch.take(pa.array(np.flatnonzero(n_of == n)))
            row, phrases, weights = paths(own, n)
            yield pa.RecordBatch.from_arrays([column(own, "lang").take(pa.array(row)), pa.array(np.full(len(row), n, np.int32)), phrases, pa.array(weights)],
                                             names=["lang", "n", "phrase", "a"])


def _marks(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, found = np.zeros((1 << bits) // 8, np.uint8), False
        for batch in slices(batches, "labels", most=LABELS):
            n_of = column(batch, "n").to_numpy()
            for n in np.unique(n_of).tolist():
                rows = batch.take(pa.array(np.flatnonzero(n_of == n)))
                row, phrases, _ = paths(rows, n)
                if len(row):
                    hashes = words(*flat(phrases), KINDS, SAME).hash
                    salt = _lang_hashes(column(rows, "lang").to_pylist())[row]
                    at = (mix(runs_of(hashes, n)[::n] + salt) >> np.uint64(64 - bits)).astype(np.int64)
                    np.bitwise_or.at(marks, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))
                    found = True
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(marks.tobytes(), 1)], pa.binary())], names=["marks"])

    return run


def _ranged(rows: DataFrame) -> DataFrame:
    return rows.repartition("lang", "n", "range").sortWithinPartitions("lang", "n", "range")


def _bitmap(counts: DataFrame, bits: int) -> np.ndarray:
    """The phrases of ``counts`` as a bitmap; each task sends one, compressed."""
    marks = np.zeros((1 << bits) // 8, np.uint8)
    for row in counts.where("range >= 0").select("lang", "n", "labels", "depths", "weights").mapInArrow(_marks(bits), "marks binary").toLocalIterator():
        marks |= np.frombuffer(zlib.decompress(bytes(row.marks)), np.uint8)
    return marks


def phrase_automata(docs: DataFrame, longest: int, least: int, held: int = HELD, mark_bits: int = MARK_BITS) -> DataFrame:
    """Automata of all phrases of up to ``longest`` words that occur ``least`` times in a language; rows of range -1 hold ``total``, the n-grams counted."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    found: list[DataFrame] = []
    for sizes in ([1], [2], list(range(3, longest + 1))):
        if sizes and sizes[0] <= longest:
            marks = _bitmap(found[-1], mark_bits) if found else None
            shards = _ranged(rows.mapInArrow(_counted(sizes, marks, held), PIECES))
            found.append(saved(shards.mapInArrow(_united(least, held), PIECES), "phrase_counts"))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def part_counts(automata_: DataFrame, parts: DataFrame) -> DataFrame:
    """lang, part, f of the distinct rows (lang, part, n words) of ``parts``, by composing their automata with those of the counts."""
    asked = parts.mapInArrow(_asked, PIECES)
    return _ranged(automata_.where("range >= 0").unionByName(asked)).mapInArrow(_answered, "lang string, part string, f long")


def _uncovered(phrases: DataFrame, longest: int, cover: tuple[int, int]) -> DataFrame:
    """Phrases of two words or more that no longer one contains and nearly replaces."""
    split = F.split("phrase", " ")
    spans = [F.when((F.col("n") >= at + size) & (F.col("n") > size), F.array_join(F.slice(split, at + 1, size), " "))
             for size in range(2, longest) for at in range(longest - size + 1)]
    shorter = phrases.where("n > 2").select("lang", "a", F.explode(F.array(*spans)).alias("phrase")).where("phrase is not null")
    most = shorter.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    part, whole = cover
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    kept = F.col("longer").isNull() | (wide("longer") * whole < wide("a") * part)
    return phrases.where("n > 1").join(most, ["lang", "phrase"], "left").where(kept).drop("longer")


def floor_ratio(a: Column, l: Column, r: Column, scale: int) -> Column:
    """floor(scale * a / (l + r)) without rounding, whatever the size of the product."""
    wide = lambda c: c.cast("decimal(20,0)")
    top, under = wide(a) * F.lit(scale), wide(l) + wide(r)
    return F.call_function("div", top, under)


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, top: int = 2000, cover: tuple[int, int] = (80, 100),
                 scale: int = 2_000_000, held: int = HELD, mark_bits: int = MARK_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases of 2 to ``longest`` words that occur ``least`` times.

    A phrase is cut into two parts of counts l and r where floor(scale * a / (l + r)) is lowest, at the earliest such place. Phrases within a longer one
    that occurs ``cover`` as often or more are left out. ``n`` counts the words of the language.
    """
    counted = phrase_automata(docs, longest, least, held, mark_bits)
    listed = saved(counted.where("range >= 0 and n > 1").select("lang", "n", "labels", "depths", "weights").mapInArrow(
        _listed, "lang string, n int, phrase string, a long"), "phrases")
    split = F.split("phrase", " ")
    cuts = saved(
        _uncovered(listed, longest, cover).select("lang", "n", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
        .withColumn("first", F.array_join(F.slice(split, F.lit(1), F.col("k")), " "))
        .withColumn("rest", F.array_join(F.slice(split, F.col("k") + 1, F.col("n") - F.col("k")), " ")), "cuts")
    asked = cuts.select("lang", F.explode(F.array(F.struct(F.col("first").alias("part"), F.col("k").alias("n")),
                                                  F.struct(F.col("rest").alias("part"), (F.col("n") - F.col("k")).alias("n")))).alias("p")).select("lang", "p.*")
    answers = saved(part_counts(counted, asked), "part_counts")
    # A frequent word is the part of very many phrases: both sides are plain tables, so AQE splits its partition.
    side = lambda part, name: answers.select("lang", F.col("part").alias(part), F.col("f").alias(name))
    scored = cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"]).withColumn(
        "score", floor_ratio(F.col("a"), F.col("l"), F.col("r"), scale))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.select("lang", "phrase", "a", "cut.*").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = counted.where("range = -1 and n = 1").select("lang", "total").groupBy("lang").agg(F.sum("total").alias("n"))
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "k")
