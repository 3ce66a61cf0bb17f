"""Catalogs A8-A12, A34, A35: load, match, default, classify, browse, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace import session
from millrace.functions import maps, values
from millrace.operators import skew

CATALOG_SCHEMA = T.StructType([
    T.StructField("class", T.StringType()), T.StructField("catalog_name", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("equivalent", T.StringType()),
    T.StructField("type", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("confidence", T.StringType()), T.StructField("effort", T.StringType()),
    T.StructField("required", T.ArrayType(T.StringType())), T.StructField("unsupported", T.ArrayType(T.StringType())),
])


# --- A8 ----------------------------------------------------------------------------------------------------

def normal_status(status: Column) -> Column:
    """One of the four statuses; other text counts as supported."""
    word = F.lower(status)
    return F.when(word.isin("partial", "manual", "unsupported"), word).otherwise("supported")


def override(base: DataFrame, rows: DataFrame, key: str = "class") -> DataFrame:
    """Rows of ``rows`` replace rows of ``base`` with the same key."""
    return base.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def load_catalog(spark: SparkSession, path: str | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """The default catalog, or JSON lines at ``path``, with user rows replacing rows of the same class."""
    base = spark.read.schema(CATALOG_SCHEMA).json(path) if path else spark.createDataFrame(values.CATALOG, CATALOG_SCHEMA)
    if overrides is not None:
        base = override(base, overrides)
    return base.withColumn("status", normal_status(F.col("status")))


def load_step_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(values.STEP_CATALOG, "class string, equivalent string, status string")


def load_categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(values.CATEGORIES, "category string, title string, description string")


def load_capabilities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(values.CAPABILITIES, "plugin string, required array<string>, optional array<string>")


# --- A9, A10 -----------------------------------------------------------------------------------------------

#: Length of the pieces that texts are looked up by; texts of 2, 4 or 8 times that length have pieces of that many times the length.
GRAM = 5
#: Characters of listed pieces from which on both sides are shuffled: of a list of pieces Spark's statistics know the texts' files only.
SHUFFLED_PIECES = 1 << 18


def _pieces(text: Column, size: Column) -> Column:
    """The distinct pieces of ``size`` characters of a text."""
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substr(text, i, size))))


def containing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left, right): all pairs of a text of either side where one contains the other; both have one column of distinct texts.

    An inverted index: each text is listed under its pieces of ``GRAM`` characters, and is looked up on the other side under the one of its
    own pieces that the fewest texts there have (a shorter text is a piece itself); what meets is compared. A text with a piece that the other
    side lacks is within none. Longer texts have longer pieces, so that the texts of a piece stay few as texts become many. Joins are equal
    joins on pieces, whatever the number of texts, and none broadcasts a long list of pieces.
    """
    texts = left.toDF("text").withColumn("side", F.lit(0)).unionByName(right.toDF("text").withColumn("side", F.lit(1))).where("text <> ''")
    size = F.greatest(F.least(F.length("text"), F.lit(GRAM)), *[F.when(F.length("text") >= GRAM * k, GRAM * k) for k in (2, 4, 8)])
    found, chars = texts.agg(F.collect_set(size), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()  # GRAM and three numbers at most
    sizes = F.array(*[F.lit(n) for n in found]).cast("array<int>")
    shuffled = lambda df: df.hint("merge") if chars * len(found) > SHUFFLED_PIECES else df
    listed = texts.select("text", "side", F.explode(sizes).alias("size")).select(
        F.col("text").alias("hay"), "side", F.explode(_pieces(F.col("text"), F.col("size"))).alias("piece"))
    frequency = listed.groupBy((1 - F.col("side")).alias("side"), "piece").agg(F.count(F.lit(1)).alias("n"))
    own = texts.select("text", "side", F.explode(_pieces(F.col("text"), size)).alias("piece")).join(shuffled(frequency), ["side", "piece"], "left")
    rarest = own.groupBy("text", "side").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("least")).where("least.n > 0")
    needles = rarest.select(F.col("text").alias("needle"), (1 - F.col("side")).alias("side"), F.col("least.piece").alias("piece"))
    met = listed.join(shuffled(needles), ["side", "piece"])
    in_left = F.col("side") == 0
    return met.where(F.contains("hay", "needle")).select(
        F.when(in_left, F.col("hay")).otherwise(F.col("needle")).alias("left"), F.when(in_left, F.col("needle")).otherwise(F.col("hay")).alias("right"))


def match_classes(classes: DataFrame, catalog: DataFrame) -> DataFrame:
    """(class, key): the catalog key of each distinct class.

    An equal key wins. Otherwise either text contains the other; the longest key wins, then the alphabetical first.
    """
    keys, names = catalog.select(F.col("class").alias("key")).distinct(), session.written(classes.select("class").distinct(), "classes")
    found = containing(names, keys).toDF("class", "key")
    best = F.min(F.struct(F.col("class") != F.col("key"), -F.length("key"), F.col("key").alias("key"))).alias("best")
    return found.groupBy("class").agg(best).select("class", "best.key")


def match_catalog(records: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add the catalog columns to each record by its ``class``; ``catalog_class`` is null without a match.

    Only distinct classes are compared. Their matches are written once, so a bounded count tells whether they are broadcast; where a large table
    of them meets the records by a shuffle, AQE splits the partition of a very common class. Of catalog rows that repeat a class the least by
    all its attributes counts.
    """
    rest = [c for c in catalog.columns if c != "class"]
    attributes = catalog.groupBy(F.col("class").alias("catalog_class"))
    attributes = attributes.agg(F.min(F.struct(*rest)).alias("_row")).select("catalog_class", "_row.*") if rest else attributes.agg(
        F.count(F.lit(1)).alias("_n")).drop("_n")
    matched = match_classes(records, catalog).withColumnRenamed("key", "catalog_class").join(attributes.hint("merge"), "catalog_class")
    return skew.lookup(records, skew.bounded(session.written(matched, "matches")), ["class"], "left")


def default_unmatched(matched: DataFrame) -> DataFrame:
    """A10: a record without a match is manual work of 2-5 days; ``known`` tells the two apart."""
    none = F.array().cast("array<string>")
    return matched.withColumns({
        "known": F.col("catalog_class").isNotNull(),
        "catalog_name": F.coalesce("catalog_name", F.lit("Unknown Connector")),
        "equivalent": F.coalesce("equivalent", F.lit("manual-implementation-required")),
        "status": F.coalesce("status", F.lit("manual")),
        "effort": F.when(F.col("catalog_class").isNull(), "2-5 days").otherwise(F.col("effort")),
        "required": F.coalesce("required", none),
        "unsupported": F.coalesce("unsupported", none),
    })


# --- A12 ---------------------------------------------------------------------------------------------------

def classify_steps(steps: DataFrame, step_catalog: DataFrame) -> DataFrame:
    """Add ``status`` (manual when unknown) and ``equivalent``; a ``$Key`` or ``$Value`` suffix is ignored.

    Of several rows of a class the one with the alphabetically first status counts, which is the least supported.
    """
    looked_up = steps.withColumn("_class", F.split_part("class", F.lit("$"), F.lit(1)))
    best = F.min(F.struct("status", "equivalent")).alias("_best")
    table = step_catalog.groupBy(F.col("class").alias("_class")).agg(best).select("_class", "_best.*")
    joined = skew.lookup(looked_up, table, ["_class"], "left").drop("_class")
    return joined.withColumn("status", F.coalesce("status", F.lit("manual")))


# --- A34, A35 ----------------------------------------------------------------------------------------------

def browse_catalog(catalog: DataFrame, categories: DataFrame | None = None, category: str | None = None,
                   status: str | None = None) -> DataFrame:
    """Entries of a category and status. A category that does not exist is an error."""
    if category is not None:
        if categories is not None and categories.where(F.col("category") == category).isEmpty():
            raise ValueError(f"unknown category {category!r}")
        catalog = catalog.where(F.col("category") == category)
    return catalog if status is None else catalog.where(F.col("status") == status)


def catalog_counts(catalog: DataFrame) -> DataFrame:
    """Entries per category and status."""
    return catalog.groupBy("category", "status").agg(F.count(F.lit(1)).alias("n"))


def search_catalog(catalog: DataFrame, text: str) -> DataFrame:
    """Entries whose name or class contains the text, whatever the case; ``exact`` marks an equal name."""
    wanted = text.strip().lower()
    if not wanted:
        raise ValueError("search text cannot be empty")
    name = F.lower(F.coalesce("catalog_name", F.lit("")))
    hit = F.contains(name, F.lit(wanted)) | F.contains(F.lower("class"), F.lit(wanted))
    return catalog.where(hit).withColumn("exact", name == wanted)


def suggest(catalog: DataFrame, text: str) -> DataFrame:
    """Entries to offer when nothing was found: either name contains the other."""
    wanted, name = F.lit(text.strip().lower()), F.lower("catalog_name")
    return catalog.where(F.contains(name, wanted) | ((name != "") & F.contains(wanted, name)))


def suggest_all(catalog: DataFrame, texts: DataFrame) -> DataFrame:
    """A35 for many searches at once: (text, class, catalog_name) by the same index as the catalog's own matching."""
    wanted = texts.toDF("text").distinct().withColumn("_wanted", F.lower(F.trim("text")))
    named = catalog.select("class", "catalog_name", F.lower("catalog_name").alias("_name"))
    searched, names = wanted.select("_wanted").distinct(), named.select("_name").distinct()
    pairs = containing(names, searched).toDF("_name", "_wanted").distinct()
    return wanted.join(pairs, "_wanted").join(named, "_name").select("text", "class", "catalog_name")


def catalog_quality(catalog: DataFrame) -> DataFrame:
    """One row per missing attribute: class, severity, message."""

    def missing(column: str, severity: str) -> Column:
        empty = F.coalesce(F.col(column), F.lit("")) == ""
        return F.when(empty, F.struct(F.lit(severity).alias("severity"), F.lit(f"missing {column}").alias("message")))

    checks = F.array(missing("catalog_name", "error"), missing("equivalent", "error"), missing("class", "error"),
                     missing("effort", "warning"))
    found = F.explode(F.filter(checks, lambda c: c.isNotNull())).alias("c")
    return catalog.select("class", found).select("class", "c.*")


def category_quality(categories: DataFrame) -> DataFrame:
    """Categories without a title or description."""
    rows = [categories.where(F.coalesce(F.col(c), F.lit("")) == "").select(
        "category", F.lit("warning").alias("severity"), F.lit(f"missing {c}").alias("message"))
        for c in ("title", "description")]
    return rows[0].unionByName(rows[1])
