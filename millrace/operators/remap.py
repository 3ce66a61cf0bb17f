"""Settings of records translated by rules, as joins of relations.

The settings of all records are one long table (record_id, kind, key, value). It meets the rules on (kind, source key), a translated value is
found by a second join with the value maps, and of all that a record offers for a target the one of the smallest precedence is taken by
an aggregate. Rules are rows, so a caller adds, replaces or reorders them like any other data; rules and value maps that a bounded count
shows to be small are broadcast, and then only the offered values are shuffled, once.

Conditions on other settings are rare: a setting carries those settings of its record that the conditions of its kind name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions import maps, setting_rules, text
from millrace.operators import skew

RULES = ("kind string, precedence int, target string, source string, default_value string, required boolean, secret string, value_map string, "
         "form string, part string, conditions array<struct<key:string,test:string,value:string>>")
VALUE_MAPS = "value_map string, place int, test string, pattern string, result string"
#: Rows that hold a target's default come after those of all its sources.
LAST = 1 << 30


def condition(text_: str) -> tuple[str, str, str]:
    """``key``, ``!key``, ``key=text`` or ``key~text`` as (key, test, value)."""
    for test in "=~":
        key, found, value = text_.partition(test)
        if found:
            return key, test, value
    return (text_[1:], "!", "") if text_.startswith("!") else (text_, "*", "")


def rule_rows(rules: list[tuple], kinds: list[tuple], first: int = 0) -> list[tuple]:
    """A row per kind, rule and source, and one per rule for its default; ``first`` is the precedence of the first rule."""
    rows = []
    for kind in dict.fromkeys(k for k, _, _ in kinds):
        sets = next(s for k, _, s in kinds if k == kind)
        for place, (group, target, sources, more) in enumerate(rules):
            if group in sets:
                shared = (more.get("required", False), more.get("secret"), more.get("values"), more.get("form", "{}"), more.get("part"),
                          [condition(c) for c in more.get("when", [])])
                at = (first + place) * 16
                rows += [(kind, at + k, target, source, None, *shared) for k, source in enumerate(sources)]
                rows.append((kind, LAST + at, target, None, more.get("default"), *shared))
    return rows


def default_rules(spark: SparkSession) -> DataFrame:
    kept = [(group, name, [prefix + name], {}) for group, prefix, names in setting_rules.KEPT_NAMES for name in names]
    return spark.createDataFrame(rule_rows(kept + setting_rules.RULES, setting_rules.KINDS), RULES)


def default_value_maps(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(name, place, pattern[0], pattern[1:], result)
                                  for place, (name, pattern, result) in enumerate(setting_rules.VALUE_MAPS)], VALUE_MAPS)


def rule_kind(class_name: Column) -> Column:
    """The kind whose rules apply: the first one whose parts the class name holds; null where none fits."""
    name = F.lower(class_name)
    return F.coalesce(*[
        F.when(F.forall(F.array(*[F.lit(p) for p in parts]), lambda p: F.contains(name, p)), kind) for kind, parts, _ in setting_rules.KINDS])


def _found_settings(kind: str, settings: str) -> Column:
    """Array of (key, value): the settings of a record, the parts of ``connection.url`` and a ``mongodb.uri`` put together from its parts."""
    s = F.col(settings)
    parts = ("protocol", "host", "port", "database", "user", "password")

    def from_url(url: Column) -> Column:
        return maps.bind(text.connection_url(url)["parts"], lambda p: F.concat(
            F.array(*[F.struct(F.lit(f"url.{n}").alias("key"), p[n].alias("value")) for n in parts]),
            F.transform(F.coalesce(F.map_entries(p["params"]), F.array()), lambda e: F.struct(
                F.concat(F.lit("url."), e["key"]).alias("key"), e["value"].alias("value")))))

    none = F.array().cast("array<struct<key:string,value:string>>")
    filled = lambda key: maps.filled(s[key])
    login = F.when(filled("mongodb.user").isNotNull() & filled("mongodb.password").isNotNull(),
                   F.concat(s["mongodb.user"], F.lit(":"), s["mongodb.password"], F.lit("@"))).otherwise("")
    uri = F.concat(F.lit("mongodb://"), login, filled("mongodb.hosts"),
                   F.coalesce(F.concat(F.lit("/?authSource="), filled("mongodb.authsource")), F.lit("")))
    derived = F.concat(F.when(F.startswith(s["connection.url"], F.lit("jdbc:")), F.coalesce(from_url(s["connection.url"]), none)).otherwise(none),
                       F.array(F.struct(F.lit("mongodb.uri").alias("key"), uri.alias("value"))))
    return F.filter(F.concat(F.coalesce(F.map_entries(s), none), derived), lambda e: e["value"] != "")


def _known(rules: DataFrame) -> DataFrame:
    """kind, asked: the keys that the conditions of a kind's rules name."""
    asked = rules.select("kind", F.explode("conditions").alias("c"))
    return asked.groupBy("kind").agg(F.collect_set("c.key").alias("asked"))


def _holds(found: Column, conditions: Column) -> Column:
    """Whether the settings ``found`` meet all conditions."""
    value = lambda c: maps.filled(F.element_at(found, c["key"]))
    return F.forall(conditions, lambda c: F.coalesce(
        F.when(c["test"] == "!", value(c).isNull()).when(c["test"] == "*", value(c).isNotNull())
        .when(c["test"] == "=", value(c) == c["value"]).otherwise(F.contains(value(c), c["value"])), F.lit(False)))


def _translated(rows: DataFrame, value_maps: DataFrame) -> DataFrame:
    """Values put through their value map: the first pattern that fits; its null drops the row, and a value that nothing fits stays."""
    patterns = value_maps.where("value_map is not null").groupBy("value_map").agg(
        F.sort_array(F.collect_list(F.struct("place", "test", "pattern", "result"))).alias("_patterns"))
    offered = F.col("source").isNotNull()
    fits = F.filter("_patterns", lambda m: F.when(m["test"] == "=", F.col("value") == m["pattern"]).otherwise(
        F.contains(F.lower("value"), F.lower(m["pattern"]))))
    mapped = rows.join(skew.bounded(patterns), "value_map", "left").withColumn("_fit", F.when(offered, F.get(fits, F.lit(0)))).drop("_patterns")
    kept = mapped.where(F.col("_fit").isNull() | F.col("_fit.result").isNotNull())
    return kept.withColumn("value", F.coalesce("_fit.result", "value")).drop("_fit")


def remap_settings(records: DataFrame, rules: DataFrame | None = None, value_maps: DataFrame | None = None, kind: str = "kind",
                   settings: str = "settings") -> DataFrame:
    """record_id, kind, target, value, source, required: one row per record and target that its kind's rules name and give a value or require.

    ``source`` is the setting the value came from (null for a default); a required target without a value has a null ``value``
    and the setting it should have come from. record_id identifies a record; kinds without rules give no rows.
    """
    spark = records.sparkSession
    rules = default_rules(spark) if rules is None else rules
    value_maps = default_value_maps(spark) if value_maps is None else value_maps
    # Defaults, and targets that must have a value, are rules without a source; the one they name is the first one of the target.
    named = rules.groupBy("kind", "target").agg(F.min_by("source", "precedence").alias("named"))
    usable = skew.bounded(rules.where("source is not null or default_value is not null or required").join(named, ["kind", "target"]))

    # Behind ``inline``, so that the addresses are parsed once. One more entry without a key meets the rules without a source.
    found = records.where(F.col(kind).isNotNull()).select(
        "record_id", F.col(kind).alias("kind"), F.inline(F.array(F.struct(_found_settings(kind, settings).alias("found")))))
    asked = found.join(skew.bounded(_known(rules)), "kind", "left")
    known = F.filter("found", lambda e: F.array_contains(F.col("asked"), e["key"]))
    none = F.create_map().cast("map<string,string>")
    entries = asked.withColumn("known", F.coalesce(maps.last_wins(known), none)).select("record_id", "kind", "known", F.explode(
        F.concat("found", F.array(F.lit(None).cast("struct<key:string,value:string>")))).alias("e"))
    # A rule for ``headers.*`` takes all settings of that prefix: a key is also looked up by its first part.
    first_part = F.concat(F.split_part("e.key", F.lit("."), F.lit(1)), F.lit(".*"))
    lookups = entries.select("record_id", "kind", "known", "e.key", "e.value", F.explode(
        F.when(F.contains("e.key", F.lit(".")), F.array("e.key", first_part)).otherwise(F.array("e.key"))).alias("looked_up"))
    met = lookups.join(usable.withColumnRenamed("kind", "_kind"), (F.col("kind") == F.col("_kind")) & F.col("looked_up").eqNullSafe(F.col("source")))
    met = met.where((F.size("conditions") == 0) | _holds(F.col("known"), F.col("conditions"))).drop("known", "conditions")

    offered = F.col("source").isNotNull()
    rest = F.substr("key", F.length("source"))
    target = F.when(F.endswith("source", F.lit("*")), F.replace("target", F.lit("*"), rest)).otherwise(F.col("target"))
    part = (
        F.when(~offered, F.col("default_value"))
        .when(F.col("part") == "first", maps.trimmed(F.split_part("value", F.lit(","), F.lit(1))))
        .when(F.col("part") == "before", F.when(F.contains("value", F.lit(":")), F.split_part("value", F.lit(":"), F.lit(1))))
        .when(F.col("part") == "after", maps.filled(F.regexp_extract("value", r"(?s)^[^:]*:(.*)$", 1)))
        .otherwise(F.col("value"))
    )
    met = met.withColumns({"target": target, "value": part}).where(~offered | F.col("value").isNotNull())
    met = _translated(met, value_maps)
    shown = F.when(F.col("secret").isNull(), F.col("value")).otherwise(text.masked(F.col("secret"), F.col("value")))
    met = met.withColumn("value", F.when(offered, F.replace("form", F.lit("{}"), shown)).otherwise(F.col("value")))
    source = F.when(offered, F.col("key")).otherwise(F.col("named"))
    best = F.struct((F.col("value").isNull()).alias("unmet"), "precedence", "value", F.when(
        F.col("value").isNull() | (F.col("precedence") < LAST), source).alias("source"))
    # The rows are dealt before they are compared: a comparison of texts sorts, and sorted parts of a large shuffle stay small.
    dealt = met.select("record_id", "kind", "target", best.alias("best"), "required").repartition("record_id", "kind", "target")
    return (
        dealt.groupBy("record_id", "kind", "target")
        .agg(F.min("best").alias("best"), F.max("required").alias("required"))
        .where("best.value is not null or required")
        .select("record_id", "kind", "target", "best.value", "best.source", "required")
    )


def remapped_records(remapped: DataFrame) -> DataFrame:
    """record_id, ``remapped`` (target -> value) and ``unmet`` (required targets without a value, sorted)."""
    return remapped.groupBy("record_id").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("target", "value")))).alias("remapped"),
        F.sort_array(F.collect_list(F.when(F.col("value").isNull(), F.col("target")))).alias("unmet"))


def unmet_issues(remapped: DataFrame) -> DataFrame:
    """An issue for each required setting that no rule could fill."""
    return remapped.where("value is null").select(
        "record_id", F.lit("error").alias("severity"), F.col("source").alias("field"),
        F.concat(F.lit("nothing to fill "), "target", F.lit(" of "), "kind", F.lit(" from")).alias("message"))
