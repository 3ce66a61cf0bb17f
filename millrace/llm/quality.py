"""Quality classifier: importance resampling with hashed n-gram models (operator 1).

Two generative models count hashed unigrams and bigrams: one of target text (labelled good, a bounded sample), one of all raw text. A
document's weight is the log of the ratio of its probabilities. Documents are sampled without replacement in proportion to their weights
by adding Gumbel noise drawn from the id and keeping the k highest (Gumbel top-k).

The k-th highest score is found by halving ranges of a narrow table of scores: each pass counts documents in a fixed number of bins, so
neither the driver nor any task holds the scores.

Defined results: null and empty texts have no n-gram and weight 0; repeated rows share noise and score and so stay or go
together; equal scores at the limit all stay. A null id is drawn like an empty one. Without target text, or when k reaches the
number of rows, all rows stay. An empty table gives no rows. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.store import column, frugal, saved, slices
from millrace.llm.text import SAME, WORD_OR_SIGN, flat, mix, words

#: Counted bins of hashed n-grams. The models hold so many numbers each, whatever the corpus.
BINS = 1 << 14
PARTS = 16
#: Counts that each model is given for every bin, so that rare n-grams say little.
PSEUDO = 2.0
#: What an n-gram may be less likely in the target, as a log, before it counts against a document.
TOLERANCE = 0.05
#: Target rows, about: picked by a hash of doc_id.
TARGET_DOCS = 20_000
FIXED = 1 << 20
SPLIT = 4096
_AGAIN = np.uint64(0x5A5A5A5A5A5A5A5A)


def bins(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, bin) of every word or run of signs, and of every pair of neighbours; all words said twice are one pair."""
    data, bounds = flat(texts)
    own = words(data, bounds, WORD_OR_SIGN, SAME)
    text = np.repeat(np.arange(len(texts)), np.diff(own.first))
    pair = mix(own.hash[:-1] * np.uint64(3) + own.hash[1:])
    pair[own.hash[:-1] == own.hash[1:]] = _AGAIN
    same = text[:-1] == text[1:] if len(text) else np.zeros(0, np.bool_)
    every = np.concatenate([own.hash, pair[same]]) >> np.uint64(64 - BINS.bit_length() + 1)
    return np.concatenate([text, text[:-1][same]]), every.astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BINS, np.int64)
    for batch in slices(batches, "text"):
        total += np.bincount(bins(column(batch, "text"))[1], minlength=BINS)
    if total.any():
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(PARTS), pa.int32()), pa.array([p.tobytes() for p in np.split(total, PARTS)], pa.binary())],
            names=["part", "counts"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[part] = total.get(part, 0) + np.frombuffer(counts, np.int64)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
                                         names=["part", "counts"])


def bin_counts(docs: DataFrame) -> np.ndarray:
    """How often each bin occurs in all texts: summed per task, then per part of the bins; ``BINS`` numbers come to the driver."""
    schema = "part int, counts binary"
    summed = docs.select("text").mapInArrow(frugal(_count), schema).repartition(PARTS, "part").mapInArrow(frugal(_add), schema)
    total = np.zeros((PARTS, BINS // PARTS), np.int64)
    for row in summed.collect():
        total[row.part] += np.frombuffer(bytes(row.counts), np.int64)
    return total.reshape(-1)


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """By bin, the log of its probability in the target over that in the raw text, and ``TOLERANCE``.

    An n-gram that is scored is part of the raw text itself, so it is left out of its bin's raw count; in a small corpus it would
    count against every document.
    """
    if not target.any() or not raw.any():
        return np.zeros(len(raw))
    expected = np.maximum(raw - 1, 0) * (target.sum() / raw.sum())
    return np.log((target + PSEUDO) / (expected + PSEUDO)) + TOLERANCE


def weighted(docs: DataFrame, ratios: np.ndarray, seed: int = 0) -> DataFrame:
    """doc_id, n_grams, log_weight and score (with noise) of every row."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = column(batch, "text")
            text, found = bins(texts)
            weight = np.bincount(text, ratios[found], len(texts))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(np.bincount(text, minlength=len(texts)).astype(np.int64)), pa.array(weight)],
                names=["doc_id", "n_grams", "log_weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(frugal(weigh), f"doc_id {kind}, n_grams long, log_weight double")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    even = (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return rows.withColumn("score", F.col("log_weight") - F.log(-F.log(even)))


def kth_highest(values: DataFrame, name: str, k: int) -> int:
    """The k-th highest of a column of integers."""
    span = values.agg(F.min(name).alias("low"), F.max(name).alias("high")).first()
    low, high, above = span.low, span.high, 0
    while low < high:
        width = max(1, -(-(high - low + 1) // SPLIT))
        place = F.floor((F.col(name) - F.lit(low)) / F.lit(width)) if width < 1 << 40 else F.expr(
            f"({name} - {low}L) div {width}L")
        counts = values.where(F.col(name).between(low, high)).groupBy(place.cast("long").alias("place")).count()
        for place_at, n in sorted(((r.place, r["count"]) for r in counts.collect()), reverse=True):
            if above + n >= k:
                low, high = low + place_at * width, min(high, low + (place_at + 1) * width - 1)
                break
            above += n
    return low


def resampled(docs: DataFrame, target: DataFrame, k: int | None = None, seed: int = 0) -> DataFrame:
    """doc_id, log_weight, score of the documents that are kept.

    ``k`` unset is the size that the weights call for: the sum of min(1, weight), so all documents count that target text is at
    least as likely to hold, and the others by their weight.
    """
    ratios = log_ratio(bin_counts(target), bin_counts(docs))
    fixed = F.floor(F.col("score") * FIXED).cast("long").alias("fixed")
    rows = saved(weighted(docs, ratios, seed).select("*", fixed), "weights")
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.least(F.lit(1.0), F.exp("log_weight"))).alias("k")).first()
    k = round(found.k or 0) if k is None else k
    if k >= found.n:
        return rows.drop("fixed", "n_grams")
    limit = kth_highest(rows.select("fixed"), "fixed", max(1, k))
    return rows.where(F.col("fixed") >= limit).drop("fixed", "n_grams")


def target_text(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """About ``TARGET_DOCS`` of the documents labelled good, picked by a hash of doc_id."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("target")), F.lit(1 << 20))
    share = min(1.0, TARGET_DOCS / max(1, good.count()))
    picked = good.where(draw < int(share * (1 << 20))).limit(2 * TARGET_DOCS)
    return docs.join(F.broadcast(picked), "doc_id", "left_semi")
