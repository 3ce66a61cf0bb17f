"""Mixing sources to target weights: Sainte-Laguë apportionment of equal blocks of words (operator 8).

DataFrame operations only. Every source gets a target (``source_targets``). The whole mix is cut into blocks of equally many
words; the highest quotients ``target / (2 * seat - 1)`` win them, first among sources, then among the shards of a
source (by the shard's words). A shard lays its documents out in an order drawn from the seed and takes its quota of blocks
from the front, round again where the quota exceeds the shard.

Defined results: a null text has size 0; null sources are one source, ordered last; repeated rows are documents of their
own; a null id is drawn like an empty one. Without words all targets and takings are 0. An empty table gives no rows.
Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.store import saved

WORD = r"[^\x20\x09-\x0D]+"
#: Words in a block. The mix holds whole blocks, so each source is within about half of one of its target.
BLOCK_WORDS = 64
#: Documents in a shard, about. A shard is the largest group that one task orders.
SHARD_DOCS = 2048
#: No document is used more often than this.
MOST = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def drawn(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_rank, source_size, docs, target, from rows of (source, size).

    Weights are 1, 2, 3, 1, ... by source. The targets share all sizes by weight and stop at three times the source's size; what is
    over goes to the others by weight. In the order of cap / weight, the sources that stop are a prefix, so one pass of running
    sums finds the level of the rest. The windows see one row per source.
    """
    one = W.partitionBy(F.lit(0))
    by_source = one.orderBy(F.col("source").asc_nulls_last())
    by_cap = one.orderBy(F.col("cap") / F.col("weight"), "source_rank")
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    ranked = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
        .withColumn("source_rank", F.row_number().over(by_source))
        .withColumn("weight", ((F.col("source_rank") - 1) % 3 + 1).cast("long"))
        .withColumn("cap", F.col("source_size") * MOST)
        .withColumn("place", F.row_number().over(by_cap))
        .withColumn("words", F.sum("source_size").over(one) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("words").cast("double") / F.col("weights"))
    )
    level = F.min(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct("place", "level"))).over(one)["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return ranked.select("source", "source_rank", "source_size", "docs", target.alias("target"))


def apportioned(parties: DataFrame, group: list[str], party: str, votes: str, seats: str) -> DataFrame:
    """``parties`` with ``quota``: the ``seats`` of each group given to the highest quotients votes / 1, / 3, / 5, ...

    With n parties, a party's seats differ from its share by no more than the bounds below, so the certain seats are counted, and
    only about two quotients per party are ranked. Equal quotients go to the smaller ``party``.
    """
    within = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    share = F.when(F.col("_all") > 0, F.col(votes) / F.col("_all")).otherwise(F.lit(0.0))
    spread = F.col("_n") / 2
    least = F.greatest(F.lit(0.0), F.ceil(share * (F.col(seats) - spread) - 0.5 - 1e-6)).cast("long")
    most = F.when(F.col(votes) > 0, F.floor(share * (F.col(seats) + spread) + 0.5 + 1e-6)).otherwise(0).cast("long")
    bounded = (
        parties.withColumn("_all", F.sum(votes).over(within).cast("double"))
        .withColumn("_n", F.count(F.lit(1)).over(within))
        .withColumn("_least", F.least(least, most)).withColumn("_most", most)
        .withColumn("_left", F.col(seats) - F.sum("_least").over(within))
    )
    # Seat 0 stands for the party itself, so that every party stays.
    open_seats = F.concat(F.array(F.lit(0).cast("long")), F.when(
        F.col("_most") > F.col("_least"), F.sequence(F.col("_least") + 1, F.col("_most"))
    ).otherwise(F.array().cast("array<long>")))
    quotient = F.when(F.col("_seat") > 0, F.col(votes) / (2 * F.col("_seat") - 1))
    ranked = bounded.withColumn("_seat", F.explode(open_seats)).withColumn("_won", F.row_number().over(
        within.orderBy(quotient.desc_nulls_last(), party, "_seat")))
    won = F.sum(F.when((F.col("_seat") > 0) & (F.col("_won") <= F.col("_left")), 1).otherwise(0))
    columns = [c for c in parties.columns]
    return ranked.groupBy(*columns, "_least").agg(won.alias("_won")).select(
        *columns, (F.col("_least") + F.col("_won")).cast("long").alias("quota"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS, seed: str = "mix") -> DataFrame:
    """doc_id, size, source, source_size, target, taken: the words of each document that the mix takes, repeats counted.

    The mix takes the document ``taken // size`` times whole and then its first ``taken % size`` words.
    """
    sizes = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    sources = saved(source_targets(sizes), "sources")
    blocks = F.floor(F.sum("target").over(W.partitionBy(F.lit(0))) / block_words + 1e-9).cast("long")
    quotas = apportioned(sources.withColumn("blocks", blocks), [], "source_rank", "target", "blocks")
    shards = F.ceil(F.col("docs") / shard_docs).cast("long")
    draw = drawn(F.col("doc_id"), seed)
    placed = (
        sizes.join(sources, sizes["source"].eqNullSafe(sources["source"]))
        .select("doc_id", "size", sizes["source"].alias("source"), "source_rank", "source_size", "target", draw.alias("draw"),
                F.pmod(F.conv(F.substring(draw, 1, 8), 16, 10).cast("long"), shards).alias("shard"))
    )
    parties = placed.groupBy("source_rank", "shard").agg(F.sum("size").alias("shard_size"))
    parties = parties.join(quotas.select("source_rank", F.col("quota").alias("blocks")), "source_rank")
    shares = apportioned(parties, ["source_rank"], "shard", "shard_size", "blocks")
    whole = F.col("shard_size")
    take = F.least(F.col("quota") * block_words, whole * MOST)
    shares = shares.withColumn("rounds", F.when(whole > 0, F.floor(take / whole)).otherwise(0).cast("long")).select(
        "source_rank", "shard", "rounds", (take - F.col("rounds") * whole).alias("rest"))
    line = W.partitionBy("source_rank", "shard").orderBy("draw", "doc_id", "size")
    end = F.sum("size").over(line.rowsBetween(W.unboundedPreceding, 0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - (F.col("end") - F.col("size"))))
    return placed.withColumn("end", end).join(shares, ["source_rank", "shard"]).select(
        "doc_id", "size", "source", "source_size", "target",
        (F.col("rounds") * F.col("size") + part).cast("long").alias("taken"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: each document as often as it is taken whole, then a copy cut to the words that remain.

    Columns are those of ``docs``; a cut copy joins its words by single spaces and has its ``n_chars`` counted again. Rows that
    share an id are matched in the order of (source, size).
    """
    names = docs.columns
    order = [F.col("source").asc_nulls_last(), "_size"]
    key = W.partitionBy("_id").orderBy(*order)
    plan = mix(docs, **options).select(
        F.col("doc_id").alias("_id"), "source", F.col("size").alias("_size"), F.col("taken").alias("_taken"))
    plan = plan.withColumn("_copy", F.row_number().over(key)).select("_id", "_copy", "_size", "_taken")
    rows = docs.withColumn("_id", F.col("doc_id")).withColumn("_size", word_count(F.col("text")))
    rows = rows.withColumn("_copy", F.row_number().over(key)).drop("_size").alias("r")
    plan = plan.alias("p")
    found = rows.join(plan, F.col("r._id").eqNullSafe(F.col("p._id")) & (F.col("r._copy") == F.col("p._copy"))).where(
        "_taken > 0")
    rounds, rest = F.floor(F.col("_taken") / F.col("_size")).cast("int"), (F.col("_taken") % F.col("_size")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), rounds), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    exploded = found.select("r.*", F.explode(copies).alias("_cut"))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), 1, F.greatest(F.col("_cut"), F.lit(1))), " ")
    text = F.when(F.col("_cut") > 0, cut).otherwise(F.col("text"))
    columns = {"text": text} | ({"n_chars": F.when(F.col("_cut") > 0, F.char_length(text).cast("long")).otherwise(
        F.col("n_chars"))} if "n_chars" in names else {})
    return exploded.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in names])
