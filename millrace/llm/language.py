"""Language identification by language-bitmask n-gram filters (operator 2).

Every language has a Bloom filter of the n-grams (four bytes, folded) that are typical of it. The filters are bit-sliced: row p of one
matrix holds bit p of all filters, a bit for each language, so the AND of an n-gram's few rows is the mask of all languages
containing it. A text's counts per language, less what the filters report by chance, decide.

Defined results: a null text and a text without letters are ``und`` with score 0; equal counts go to the language first by name; a text
with letters but no known n-gram gets the most frequent language of the training rows, score 0. Without training rows all is
``und``. Rows with a null id are not learned from and not held out; repeated rows are predicted one by one. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.store import column, slices
from millrace.llm.text import LETTERS, LOWER, flat, mix

UNKNOWN = "und"
#: Training rows per language, about: picked by a hash of doc_id.
SAMPLE_DOCS = 4096
#: N-grams kept, over all languages, and how often one must occur.
GRAMS = 1 << 17
LEAST_COUNT = 3
#: A language contains an n-gram if it is at least this fraction as frequent as in the language that has it most.
TYPICAL = 0.25
ROWS = 1 << 19
HASHES = 4
BLOCK = 1 << 20

#: Letters, and the number signs that the class of word characters holds too.
_maybe_letter = re.compile(r"[^\W\d_]")
_fold = np.where(LETTERS > 0, LOWER, np.uint8(0x20)).astype(np.uint8)


def has_letter(text: str | None) -> bool:
    return any(found[0].isalpha() for found in _maybe_letter.finditer(text or ""))


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the text, n-gram) in blocks. Bytes that aren't letters are spaces, two more stand before and after a text."""
    data, bounds = flat(texts)
    n = len(bounds) - 1
    size = np.diff(bounds) + 4
    starts = np.concatenate([[0], np.cumsum(size)])
    padded = np.full(int(starts[-1]), 0x20, np.uint8)
    for k in range(n):
        padded[starts[k] + 2:starts[k + 1] - 2] = _fold[data[bounds[k]:bounds[k + 1]]]
    for at in range(0, len(padded), BLOCK):
        piece = padded[at:at + BLOCK + 3].astype(np.uint32)
        if len(piece) < 4:
            break
        own = piece[:-3] << 24 | piece[1:-2] << 16 | piece[2:-1] << 8 | piece[3:]
        text = np.searchsorted(starts, np.arange(at, at + len(own)), side="right") - 1
        keep = (at + np.arange(len(own)) + 3 < starts[text + 1]) & (own != 0x20202020)
        yield text[keep], own[keep]


@dataclass
class Model:
    languages: list[str]
    fallback: str
    matrix: np.ndarray  # ROWS x words of 64 languages
    chance: np.ndarray  # by language, that the filter reports an n-gram it doesn't hold

    def masks(self, own: np.ndarray) -> np.ndarray:
        """For each n-gram the languages that contain it, as bits."""
        x = mix(own.astype(np.uint64))
        found = self.matrix[(x % np.uint64(ROWS)).astype(np.int64)]
        for k in range(1, HASHES):
            found = found & self.matrix[((x >> np.uint64(16 * k - 8)) % np.uint64(ROWS)).astype(np.int64)]
        return found

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        n, many = len(texts), len(self.languages)
        hits, total = np.zeros((n, many)), np.zeros(n)
        for text, own in grams(texts):
            masks = self.masks(own)
            total += np.bincount(text, minlength=n)
            for k in range(many):
                bit = (masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
                hits[:, k] += np.bincount(text, bit, minlength=n)
        if not many:
            return [UNKNOWN] * n, np.zeros(n)
        corrected = np.clip((hits - total[:, None] * self.chance) / (1 - self.chance), 0, None)
        best = corrected.argmax(1)
        top = corrected[np.arange(n), best]
        score = np.clip(top / np.maximum(total, 1), 0, 1)
        words = [has_letter(t) for t in texts.to_pylist()]
        names = [UNKNOWN if not w else self.fallback if not s else self.languages[b] for w, s, b in zip(words, top, best)]
        return names, np.where(words, score, 0.0)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        langs = column(batch, "lang").to_pylist()
        names = sorted(set(langs))
        which = np.array([names.index(x) for x in langs], np.int64)
        for text, own in grams(column(batch, "text")):
            key, n = np.unique(which[text] << 32 | own.astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in key >> 32], pa.string()), pa.array(key & 0xFFFFFFFF), pa.array(n.astype(np.int64))],
                names=["lang", "gram", "n"])


def train(docs: DataFrame) -> Model:
    """Learn from rows of (doc_id, text, lang): about ``SAMPLE_DOCS`` of each language, picked by a hash of doc_id."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    known = {r.lang: r.docs for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")).collect()}
    languages = sorted(known)
    if not languages:
        return Model([], UNKNOWN, np.zeros((ROWS, 1), np.uint64), np.zeros(0))
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, int(SAMPLE_DOCS / known[name] * (1 << 20)) + 1)])
    picked = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")])
    counted = picked.select("lang", "text").mapInArrow(_counts, "lang string, gram long, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(W.partitionBy("lang"))
    shares = counted.withColumn("share", share).where(F.col("n") >= LEAST_COUNT)
    typical = shares.withColumn("most", F.max("share").over(W.partitionBy("gram"))).where(
        F.col("share") >= TYPICAL * F.col("most"))
    per_language = max(256, GRAMS // len(languages))
    order = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = typical.withColumn("place", order).where(F.col("place") <= per_language).select("lang", "gram")
    matrix = np.zeros((ROWS, max(1, -(-len(languages) // 64))), np.uint64)
    found = kept.toPandas()
    for k, name in enumerate(languages):
        x = mix(found["gram"][found["lang"] == name].to_numpy(np.uint64))
        for j in range(HASHES):
            at = ((x >> np.uint64(max(0, 16 * j - 8))) % np.uint64(ROWS)).astype(np.int64)
            matrix[at, k // 64] |= np.uint64(1) << np.uint64(k % 64)
    filled = [float(((matrix[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean()) for k in range(len(languages))]
    fallback = min(languages, key=lambda x: (-known[x], x))
    return Model(languages, fallback, matrix, np.array(filled) ** HASHES)


def predicted(docs: DataFrame, model: Model, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` (besides text) with lang_pred and score."""
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            names, score = model.predict(column(batch, "text"))
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in columns), pa.array(names, pa.string()), pa.array(score)],
                                             names=[*columns, "lang_pred", "score"])

    rows = docs.select(*columns, "text")
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*columns).schema.fields]
    return rows.mapInArrow(label, ", ".join([*kinds, "lang_pred string", "score double"]))


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
