"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration (operator 3).

One pass over the texts makes about a dozen numbers for each: how dense the words of two lexicons are (a fixed one and one learned
from the training rows), how near they stand to the second person, and rates of capitals, punctuation and obfuscation. The trees
and the calibration are Spark's, fitted on rows of those numbers.

Defined results: null and empty texts have features 0 and are scored like any other; rows without a label train nothing; a null id
matches no label and isn't held out; repeated rows are scored one by one. With labels of one kind only, or none, every score
is their mean, or 0. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from millrace.llm.language import held_out
from millrace.llm.store import column, saved, slices
from millrace.llm.text import LETTERS, flat, words

#: Labelled rows that are learned from, at most about: picked by a hash of doc_id. A quarter calibrates, the rest trains.
TRAIN_ROWS = 20_000
#: Learned words, at most, in how many toxic texts one must be (a hundredth of them if that is more), and how much likelier there.
#: Insults of the other languages are rare words, so the share is small.
LEARNED_WORDS = 1024
LEAST_TEXTS = 5
LIKELIER = 8.0
NEAR = 6
TREES, DEPTH = 20, 3

# Our own short lists.
INSULTS = """
stupid idiot idiots moron morons loser losers scum trash garbage pathetic worthless disgusting clown clowns dumb fool fools ugly
filthy vermin coward cowards liar liars shameful imbecile jerk jerks creep creeps hate hateful despicable
""".split()
SECOND_PERSON = "you your yours yourself yourselves u ur du dich dir ihr euch tu te toi vous votre usted ustedes ti tus".split()

FEATURES = ["words", "insults", "learned", "learned_any", "second", "near", "capitals", "shouted", "signs", "marks", "mixed",
            "stretched"]


def word_hashes(listed: list[str]) -> np.ndarray:
    data, bounds = flat(pa.array(listed, pa.string()))
    return np.unique(words(data, bounds, LETTERS).hash)


def _isin(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), np.bool_)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


_insults, _second = word_hashes(INSULTS), word_hashes(SECOND_PERSON)
_is = {name: np.zeros(256, np.int8) for name in ("upper", "letter", "sign", "mark", "digit")}
_is["upper"][0x41:0x5B] = 1
_is["letter"][LETTERS > 0] = 1
_is["digit"][0x30:0x3A] = 1
_is["mark"][[0x21, 0x3F]] = 1
_is["sign"][[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = 1


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[bounds])


def features(texts: pa.Array, learned: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text. ``learned``: sorted hashes of the learned words."""
    data, bounds = flat(texts)
    own = words(data, bounds, LETTERS)
    n, first = len(texts), own.first
    count = np.diff(first)
    hit, new, second = _isin(own.hash, _insults), _isin(own.hash, learned), _isin(own.hash, _second)
    text = np.repeat(np.arange(n), count)
    hits, at = np.flatnonzero(hit | new), np.flatnonzero(second)
    near = np.zeros(n)
    if len(hits) and len(at):
        after = np.searchsorted(at, hits)
        for side in (np.maximum(after - 1, 0), np.minimum(after, len(at) - 1)):
            other = at[side]
            close = (np.abs(other - hits) <= NEAR) & (text[other] == text[hits])
            near += np.bincount(text[hits][close], minlength=n)
    length = own.end - own.start
    capitals = np.concatenate([[0], np.cumsum(_is["upper"][data], dtype=np.int64)])
    shouted = (capitals[own.end] - capitals[own.start] == length) & (length > 2)
    # Obfuscation: letters beside digits or signs inside one word, and a letter three times in a row.
    inner = np.zeros(len(data), np.bool_)
    if len(data) > 2:
        letter, odd = _is["letter"][data], _is["digit"][data] | _is["sign"][data]
        inner[1:-1] = (letter[:-2] & odd[1:-1] & letter[2:]).astype(np.bool_)
    thrice = np.zeros(len(data), np.bool_)
    if len(data) > 2:
        thrice[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (LETTERS[data[2:]] > 0) & (data[2:] < 0x80)
    size, many = np.maximum(np.diff(bounds), 1), np.maximum(count, 1)
    per_word = lambda flags: np.bincount(text[flags], minlength=n)
    return np.stack([
        np.log1p(count), per_word(hit) / many, per_word(new) / many, np.minimum(per_word(hit | new), 20),
        per_word(second) / many, near / many, _per_text(_is["upper"][data], bounds) / size, per_word(shouted) / many,
        _per_text(_is["sign"][data], bounds) / size, _per_text(_is["mark"][data], bounds) / size,
        _per_text(inner, bounds) / many, _per_text(thrice, bounds) / many,
    ], axis=1)


def _word_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and how many other texts of the batch each word is."""
    for batch in slices(batches, "text"):
        data, bounds = flat(column(batch, "text"))
        own = words(data, bounds, LETTERS)
        toxic = np.asarray(column(batch, "toxic").to_numpy(zero_copy_only=False), np.int64)
        each = [np.unique(own.of(k)) for k in range(len(toxic))]
        if not each:
            continue
        word, at = np.unique(np.concatenate(each), return_inverse=True)
        label = np.repeat(toxic, [len(e) for e in each])
        yield pa.RecordBatch.from_arrays(
            [pa.array(word.view(np.int64)), pa.array(np.bincount(at, label, len(word)).astype(np.int64)),
             pa.array(np.bincount(at, 1 - label, len(word)).astype(np.int64))], names=["word", "toxic", "other"])


def learned_words(texts: DataFrame) -> np.ndarray:
    """From rows of (text, toxic): words that toxic texts have far more often."""
    totals = texts.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    counts = texts.mapInArrow(_word_labels, "word long, toxic long, other long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    rate = (F.col("toxic") / max(1, totals.t)) / ((F.col("other") + 1) / max(1, totals.n - totals.t))
    least = max(LEAST_TEXTS, totals.t // 100)
    kept = counts.where((F.col("toxic") >= least) & (rate >= LIKELIER)).orderBy(F.desc("toxic"), "word").limit(LEARNED_WORDS)
    return np.sort(np.array([r.word for r in kept.collect()], np.int64).view(np.uint64))


def with_features(docs: DataFrame, learned: np.ndarray) -> DataFrame:
    """doc_id and a column for each feature."""
    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = features(column(batch, "text"), learned)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *(pa.array(found[:, k]) for k in range(len(FEATURES)))],
                                             names=["doc_id", *FEATURES])
    kinds = ", ".join(f"{f} double" for f in FEATURES)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(dense, f"doc_id long, {kinds}")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score of every row of ``docs`` (doc_id, text), learned from ``labels`` (doc_id, toxic)."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id is not null and toxic in (0, 1)")
    n = known.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("train")), F.lit(1 << 20))
    picked = saved(known.where(draw < int(min(1.0, TRAIN_ROWS / max(1, n)) * (1 << 20))).limit(2 * TRAIN_ROWS), "labelled")
    kinds = {r.toxic: r["count"] for r in picked.groupBy("toxic").count().collect()}
    if len(kinds) < 2:
        mean = float(next(iter(kinds), 0))
        return docs.select(F.col("doc_id").cast("long"), F.lit(mean).alias("score"))
    # At most 2 * TRAIN_ROWS rows of two numbers: a broadcast of bounded size.
    learned = learned_words(docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(picked), "doc_id").select(
        "text", "toxic"))
    table = saved(with_features(docs, learned), "features")
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="vector")
    train = saved(table.join(F.broadcast(picked), "doc_id"), "training")
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(4))
    fit, check = train.where(part != 0), train.where(part == 0)
    if fit.select("toxic").distinct().count() < 2 or check.select("toxic").distinct().count() < 2:
        fit = check = train
    fit = fit.coalesce(4)  # at most 2 * TRAIN_ROWS rows of a dozen numbers
    trees = GBTClassifier(featuresCol="vector", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=7)
    model = trees.fit(assemble.transform(fit))
    raw = vector_to_array("probability")[1]
    calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic", isotonic=True).fit(
        model.transform(assemble.transform(check)).select(raw.alias("raw"), F.col("toxic").cast("double").alias("toxic")))
    raw_scores = model.transform(assemble.transform(table)).select("doc_id", raw.alias("raw"))
    return calibration.setPredictionCol("score").transform(raw_scores).select(
        "doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"))


def predictions(docs: DataFrame, labels: DataFrame, parts: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out rows (crc32 of the id divisible by ``parts``) train nothing."""
    out = held_out(F.col("doc_id"), parts, 0)
    return scored(docs, labels.where(~out)).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
