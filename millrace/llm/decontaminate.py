"""Benchmark decontamination by the q-gram lemma (operator 10).

An item of m characters that occurs in a document with at most e edits shares at least m + 1 - q - q * e of its q-grams with the document,
and all of them on diagonals (place in the document less place in the item) that lie within e of each other. So shared q-grams are counted
in overlapping bands of diagonals, twice as wide as e + 1 and one such step apart; bands that reach the bound are verified by an
alignment within the band. Texts are compared in lower case with single spaces between words.

The benchmark comes to the driver in blocks of bounded size, each matched against all documents.

Defined results: null and empty documents match nothing; items that are null or, folded, shorter than q characters have no q-gram and are
never matched; repeated documents each give their matches, repeated items too. Overlapping matches of one item in one
document are given once, the one with fewest edits, then the first. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.store import column, frugal, slices
from millrace.llm.text import mix

Q = 8
#: Edits allowed, as a share of the item's characters; fewer where the bound would fall below one shared q-gram.
EDITS = 0.1
#: Characters of the benchmark that are matched in one pass.
ITEM_CHARS = 1 << 22
FILTER_BITS = 22

MATCHES = "doc_id long, item_id long, start int, end int, edits int"

_STEPS = [(1, np.uint64(0x9E3779B97F4A7C15)), (2, np.uint64(0xC2B2AE3D27D4EB4F)), (4, np.uint64(0x165667B19E3779F9))]


def folded(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts, each followed by a 0, and where each text begins."""
    joined = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "replace"), np.uint32)
    return joined, np.cumsum([0, *(len(t) + 1 for t in texts)])


def gram_hashes(chars: np.ndarray) -> np.ndarray:
    """A hash of the 8 characters from each place on."""
    h = chars.astype(np.uint64)
    for step, factor in _STEPS:
        if len(h) <= step:
            return np.zeros(0, np.uint64)
        h = h[:-step] * factor + h[step:]
    return mix(h)


def edit_budget(m: int) -> int:
    return max(0, min(int(m * EDITS), (m - Q) // Q))


@dataclass
class Items:
    """A block of the benchmark: its folded texts and an index of their q-grams."""

    ids: list[int]
    texts: list[str]

    def __post_init__(self):
        chars, starts = code_points(self.texts)
        hashes = gram_hashes(chars)
        at = np.arange(len(hashes))
        item = np.searchsorted(starts, at, side="right") - 1
        inside = at + Q < starts[item + 1]
        hashes, item, at = hashes[inside], item[inside], (at - starts[item])[inside]
        order = np.argsort(hashes, kind="stable")
        self.item, self.place = item[order], at[order]
        self.hash, self.first = np.unique(hashes[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.filter = np.zeros(1 << FILTER_BITS, np.bool_)
        self.filter[(self.hash >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.array([edit_budget(len(t)) for t in self.texts], np.int64)
        self.bound = self.size + 1 - Q - Q * self.edits

    def candidates(self, chars: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(document, item, lowest and highest diagonal) of the bands that reach the bound."""
        hashes = gram_hashes(chars)
        at = np.flatnonzero(self.filter[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        where = np.minimum(np.searchsorted(self.hash, hashes[at]), len(self.hash) - 1)
        real = self.hash[where] == hashes[at]
        at, where = at[real], where[real]
        many = self.first[where + 1] - self.first[where]
        ends = np.cumsum(many)
        if not len(ends):
            return []
        listed = np.repeat(self.first[where] - ends + many, many) + np.arange(ends[-1])
        item, place, pos = self.item[listed], self.place[listed], np.repeat(at, many)
        doc = np.searchsorted(starts, pos, side="right") - 1
        # Most pairs share too few q-grams in all their bands together.
        _, pair, total = np.unique(doc * len(self.texts) + item, return_inverse=True, return_counts=True)
        enough = total[pair] >= self.bound[item]
        item, place, pos, doc = item[enough], place[enough], pos[enough], doc[enough]
        if not len(doc):
            return []
        step = self.edits[item] + 1
        band = (pos - starts[doc] - place + self.size[item]) // step
        # A q-gram of the item counts once in a band, however often the document repeats it there.
        keys = np.stack([np.tile(doc, 2), np.tile(item, 2), np.concatenate([band, band - 1]), np.tile(place, 2)])
        keys = keys[:, np.lexsort(keys[::-1])]
        new = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0))
        keys = keys[:3, new]
        head = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))
        count = np.diff(np.append(head, keys.shape[1]))
        enough = head[count >= self.bound[keys[1, head]]]
        out = []
        for d, i, b in keys[:, enough].T.tolist():
            low = b * (int(self.edits[i]) + 1) - int(self.size[i])
            out.append((d, i, low, low + 2 * (int(self.edits[i]) + 1) - 1))
        return out


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best occurrence of ``item`` in ``text`` that stays on the diagonals low to high, if within ``most``.

    Cell d of row i stands for item[:i] and text[:i + low + d]. Each row takes substitutions and skipped item characters from the
    row before, then skipped text characters along the row by a running minimum.
    """
    wide = high - low + 1
    along = np.arange(wide)
    big = len(item) + wide + 1
    ends = low + along
    cost = np.where((ends >= 0) & (ends <= len(text)), 0, big)
    start = np.where(cost < big, ends, 0)
    for i, char in enumerate(item, 1):
        ends = i + low + along
        there = (ends >= 1) & (ends <= len(text))
        same = np.zeros(wide, np.bool_)
        same[there] = text[ends[there] - 1] == char
        swap = np.where(there, cost + ~same, big)
        skip = np.append(cost[1:] + 1, big)
        skip_start = np.append(start[1:], 0)
        best = np.where(swap <= skip, swap, skip)
        start = np.where(swap <= skip, start, skip_start)
        best = np.where((ends >= 0) & (ends <= len(text)), best, big)
        level = best - along
        lowest = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == lowest, along, 0))
        cost, start = lowest + along, start[source]
        cost = np.where((ends >= 0) & (ends <= len(text)), cost, big)
        if cost.min() > most:
            return None
    at = int(cost.argmin())
    return (int(cost[at]), int(start[at]), int(len(item) + low + at)) if cost[at] <= most else None


def _matcher(items: Items):
    own = [np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32) for t in items.texts]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", most=1 << 20):
            texts = [folded(t) for t in column(batch, "text").to_pylist()]
            chars, starts = code_points(texts)
            best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
            for doc, item, low, high in items.candidates(chars, starts):
                exact = texts[doc].find(items.texts[item], max(0, low), max(0, high) + len(items.texts[item]))
                if exact >= 0:  # the alignment without an edit
                    found = (0, exact, exact + len(items.texts[item]))
                else:
                    found = align(own[item], chars[starts[doc]:starts[doc + 1] - 1], low, high, int(items.edits[item]))
                if found:
                    best.setdefault((doc, item), []).append(found)
            if not best:
                continue
            doc_ids, rows = column(batch, "doc_id").to_pylist(), []
            for (doc, item), spans in best.items():
                taken: list[tuple[int, int, int]] = []
                for edits, start, end in sorted(spans):
                    if all(end <= a or start >= b for _, a, b in taken):
                        taken.append((edits, start, end))
                        rows.append((doc_ids[doc], items.ids[item], start, end, edits))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=["doc_id", "item_id", "start", "end", "edits"])
    return match


def blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark's items in blocks of about ``ITEM_CHARS`` characters; a longer item is a block of its own."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text").toLocalIterator():
        text = folded(row.text)
        if len(text) < Q:
            continue
        if texts and size + len(text) > ITEM_CHARS:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row.item_id)
        texts.append(text)
        size += len(text)
    if texts:
        yield Items(ids, texts)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, edits: where items occur, in characters of the folded document."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    found = docs.sparkSession.createDataFrame([], MATCHES)
    for items in blocks(benchmark):
        found = found.unionByName(rows.mapInArrow(frugal(_matcher(items)), MATCHES))
    return found
