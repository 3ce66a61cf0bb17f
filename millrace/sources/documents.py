"""Definition documents A1-A6: scan, parse, heads, steps, scopes.

A document stays one row with a map of settings. Parsing, heads and steps are projections of that row, so a table of any
size is read in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions import maps, values


# --- A1 ----------------------------------------------------------------------------------------------------

def document_format(path: Column) -> Column:
    """json, properties, or null for an unsupported extension."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))
    return F.when(suffix.isin("json", "properties"), suffix)


def is_worker(path: Column) -> Column:
    """Worker documents are properties files whose name holds ``worker`` or ``connect-``."""
    file = F.lower(F.regexp_extract(path, r"([^/]*)$", 1))
    return maps.contains_any(file, ("worker", "connect-")) & F.endswith(file, F.lit(".properties"))


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """All .json and .properties files below ``path``: record_id (the path), format, worker, text."""
    files = spark.read.text(
        path, wholetext=True, recursiveFileLookup=True,
        pathGlobFilter="*.{[jJ][sS][oO][nN],[pP][rR][oO][pP][eE][rR][tT][iI][eE][sS]}")
    name = F.col("_metadata.file_path")
    return files.select(name.alias("record_id"), document_format(name).alias("format"), is_worker(name).alias("worker"),
                        F.col("value").alias("text"))


# --- A2, A3 ------------------------------------------------------------------------------------------------

_JSON_MAP = "map<string,string>"


def json_settings(text: Column) -> Column:
    """Map of the top-level keys; nested values stay JSON text. Null when the text is not a JSON object.

    A document wrapped as ``{"name": ..., "config": {...}}`` without a class of its own is unwrapped.
    """

    def unwrap(top: Column) -> Column:
        outer = F.filter(F.map_entries(top), lambda e: e["key"] != "config")
        inside = maps.bind(F.from_json(top["config"], _JSON_MAP), lambda config: F.coalesce(
            maps.last_wins(F.concat(outer, F.map_entries(config))), top))
        bare = top["connector.class"].isNull() & top["class"].isNull()
        return F.when(bare & F.startswith(F.ltrim(top["config"]), F.lit("{")), inside).otherwise(top)

    parsed = F.when(F.ltrim(text).startswith("{"), F.from_json(text, _JSON_MAP))
    return maps.bind(maps.bind(parsed, maps.distinct_keys), unwrap)


# A comment line, or a line with the lines its trailing backslashes join to it.
_LOGICAL_LINE = r"[ \t]*[#!][^\n]*(?:\n|\z)|(?:[^\n]*\\[ \t\r]*\n)*[^\n]*(?:\n|\z)"


def properties_settings(text: Column) -> Column:
    """Map of a properties text: ``#`` and ``!`` comments, continuations, first ``=`` splits, one pair of matching quotes
    removed, the last of a repeated key stays."""
    body = F.regexp_replace(text, r"\r?\n\z", "")
    lines = F.regexp_extract_all(body, F.lit(_LOGICAL_LINE), F.lit(0))
    joined = F.transform(F.filter(lines, lambda line: ~line.rlike(r"^\s*[#!]")),
                         lambda line: maps.trimmed(F.regexp_replace(line, r"\\[ \t\r]*\n[ \t]*", "")))
    kept = F.filter(joined, lambda line: F.instr(line, "=") > 1)

    def pair(line: Column) -> Column:
        key = maps.trimmed(F.regexp_extract(line, r"(?s)^([^=]*)=", 1))
        value = maps.trimmed(F.regexp_extract(line, r"(?s)^[^=]*=(.*)$", 1))
        return F.struct(key.alias("key"), F.regexp_replace(value, r"(?s)\A([\"'])(.*)\1\z", "$2").alias("value"))

    return maps.last_wins(F.transform(kept, pair))


def parse_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with ``settings``, dead letters with ``error``) from rows of format and text."""
    tagged = tag_documents(docs)
    good = tagged.where(F.col("error").isNull()).drop("error")
    return good, tagged.where(F.col("error").isNotNull()).drop("settings")


def tag_documents(docs: DataFrame) -> DataFrame:
    """One pass: add ``settings`` and ``error`` (null when the document could be read).

    The parse sits behind ``inline``: a later filter on ``error`` cannot be pushed below it and parse twice.
    """
    settings = (
        F.when(F.col("format") == "json", json_settings(F.col("text")))
        .when(F.col("format") == "properties", properties_settings(F.col("text")))
    )
    error = (
        F.when(F.col("format").isNull(), "unsupported file format")
        .when(F.col("settings").isNull(), "document is not a JSON object")
    )
    parsed = F.inline(F.array(F.struct(settings.alias("settings"))))
    return docs.select("*", parsed).withColumn("error", error).drop("text")


def entries(records: DataFrame) -> DataFrame:
    """Long form: record_id, key, value."""
    return records.select("record_id", F.explode("settings"))


# --- A4 ----------------------------------------------------------------------------------------------------

def is_head_key(key: Column) -> Column:
    return key.isin(*values.HEAD_KEYS) | F.startswith(key, F.lit("transforms."))


def record_heads(records: DataFrame, settings: str = "settings") -> DataFrame:
    """Add name, class, tasks_max, topics, topics_regex, converters and ``rest`` (what is not lifted out)."""
    s = F.col(settings)
    number = s["tasks.max"].try_cast("double").try_cast("int")
    return records.withColumns({
        "name": F.coalesce(s["name"], F.lit("")),
        "class": F.coalesce(s["connector.class"], s["class"], F.lit("")),
        "tasks_max": F.coalesce(number, F.lit(0)),
        "topics": F.coalesce(maps.listed(s["topics"]), F.array().cast("array<string>")),
        "topics_regex": F.coalesce(s["topics.regex"], F.lit("")),
        "key_converter": F.coalesce(s["key.converter"], F.lit("")),
        "value_converter": F.coalesce(s["value.converter"], F.lit("")),
        "header_converter": F.coalesce(s["header.converter"], F.lit("")),
        "rest": F.map_filter(s, lambda k, v: ~is_head_key(k)),
    })


# --- A5 ----------------------------------------------------------------------------------------------------

def _truth(text: Column) -> Column:
    return F.coalesce(F.lower(text).isin("1", "t", "true"), F.lit(False))


def steps_of(settings: Column) -> Column:
    """The listed steps in order: array of (pos, step, class, predicate, negate, step_settings).

    The list is comma text or a JSON array. Nested keys such as ``target.type`` belong to the step's settings.
    """
    text = maps.trimmed(settings["transforms"])
    listed = F.when(F.startswith(text, F.lit("[")),
                    F.filter(F.transform(F.from_json(text, "array<string>"), maps.trimmed), lambda n: n != "")
                    ).otherwise(maps.listed(text))

    def all_steps(mine: Column) -> Column:
        def step(name: Column, pos: Column) -> Column:
            return maps.bind(F.concat(F.lit("transforms."), name, F.lit(".")), lambda prefix: maps.bind(
                F.map_filter(mine, lambda k, v: F.startswith(k, prefix)),
                lambda found: _step_fields(found, name, pos, prefix)))

        return F.transform(F.coalesce(listed, F.array().cast("array<string>")), step)

    return maps.bind(F.map_filter(settings, lambda k, v: F.startswith(k, F.lit("transforms."))), all_steps)


def _step_fields(mine: Column, name: Column, pos: Column, prefix: Column) -> Column:
    def own(key: str) -> Column:
        return F.element_at(mine, F.concat(prefix, F.lit(key)))

    suffixes = F.transform_keys(mine, lambda k, v: F.substr(k, F.length(prefix) + 1))
    return F.struct(
        pos.alias("pos"), name.alias("step"), F.coalesce(own("type"), F.lit("")).alias("class"),
        maps.filled(own("predicate")).alias("predicate"), _truth(own("negate")).alias("negate"),
        F.map_filter(suffixes, lambda k, v: ~k.isin("type", "predicate", "negate", "")).alias("step_settings"))


def explode_steps(records: DataFrame, settings: str = "settings") -> DataFrame:
    """One row per step: record_id, pos, step, class, predicate, negate, step_settings."""
    return records.select("record_id", F.inline(steps_of(F.col(settings))))


# --- A6 ----------------------------------------------------------------------------------------------------

def scope_by_prefix(records: DataFrame, prefixes: Sequence[str], settings: str = "settings") -> DataFrame:
    """Add one map per prefix (``consumer.`` gives ``consumer_settings``) with the prefix removed."""
    return records.withColumns({f"{p.rstrip('.')}_settings": maps.scoped(F.col(settings), p) for p in prefixes})


def worker_heads(workers: DataFrame, settings: str = "settings") -> DataFrame:
    """Worker documents: brokers, group, registry URL, security, override maps, plugin path list."""
    s = F.col(settings)
    named = workers.withColumns({
        "brokers": s["bootstrap.servers"], "group_id": s["group.id"],
        "key_converter": s["key.converter"], "value_converter": s["value.converter"],
        "registry_url": s["schema.registry.url"], "security_protocol": s["security.protocol"],
        "config_topic": s["config.storage.topic"], "offset_topic": s["offset.storage.topic"],
        "status_topic": s["status.storage.topic"], "plugin_path": maps.listed(s["plugin.path"]),
    })
    return scope_by_prefix(named, ["consumer.", "producer.", "admin."], settings)


def first_worker(workers: DataFrame) -> DataFrame:
    """The worker document with the lowest path, as one row."""
    picked = F.min_by(F.struct(*workers.columns), "record_id").alias("w")
    return workers.agg(picked).where(F.col("w").isNotNull()).select("w.*")
