"""Audits A11, A13, A28-A33. Every check yields rows of one issue table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import values
from millrace.operators import catalog, skew
from millrace.sources import documents

SEVERITIES = ("error", "warning", "info")
ISSUE = "struct<severity:string,field:string,message:string,suggestion:string,auto_fixable:boolean>"


def issue(severity: str, field: Column | str, message: Column | str, suggestion: str = "") -> Column:
    def text(value: Column | str) -> Column:
        return F.lit(value) if isinstance(value, str) else value

    return F.struct(F.lit(severity).alias("severity"), text(field).alias("field"), text(message).alias("message"),
                    F.lit(suggestion).alias("suggestion"), F.lit(False).alias("auto_fixable"))


def _listed(df: DataFrame, issues: Column, *ids: str) -> DataFrame:
    return df.select(*ids, F.inline(issues))


def collect_issues(*tables: DataFrame) -> DataFrame:
    """One long issue table."""
    return reduce(DataFrame.unionByName, tables)


# --- A10, A11, A12 as issues -------------------------------------------------------------------------------
# Each check is an array column over matched records, so all of them run in the pass that reads the records.

def unknown_class() -> Column:
    return F.array_compact(F.array(F.when(~F.col("known"), issue(
        "warning", "connector.class", "Unknown connector class", "Check whether this needs a manual implementation"))))


def _has(key: Column, settings: Column) -> Column:
    """Whether a record has a setting; the lifted-out keys must also hold something."""
    return (
        F.when(key == "name", F.col("name") != "")
        .when(key.isin("connector.class", "class"), F.col("class") != "")
        .when(key == "tasks.max", F.col("tasks_max") > 0)
        .when(key == "topics", F.size("topics") > 0)
        .when(key == "topics.regex", F.col("topics_regex") != "")
        .otherwise(F.map_contains_key(settings, key))
    )


def missing_required(settings: str = "settings") -> Column:
    lacking = F.filter("required", lambda k: ~_has(k, F.col(settings)))
    return F.transform(lacking, lambda k: issue("error", k, "Required field missing", "Add this field to the definition"))


def forbidden_values(settings: str = "settings") -> Column:
    s = F.col(settings)

    def key(feature: Column) -> Column:
        return F.split_part(feature, F.lit("="), F.lit(1))

    def present(feature: Column) -> Column:
        wanted = F.substr(feature, F.length(key(feature)) + 2)
        return F.when(F.contains(feature, F.lit("=")), F.coalesce(F.element_at(s, key(feature)) == wanted, F.lit(False))
                      ).otherwise(F.map_contains_key(s, feature))

    return F.transform(F.filter("unsupported", present), lambda f: issue(
        "warning", key(f), F.concat(F.lit("Unsupported feature detected: "), f),
        "This feature may need manual configuration"))


def audit_required_keys(matched: DataFrame, settings: str = "settings") -> DataFrame:
    """An error per required key a record lacks."""
    return _listed(matched, missing_required(settings), "record_id")


def audit_forbidden_values(matched: DataFrame, settings: str = "settings") -> DataFrame:
    """A warning per unsupported ``key=value`` a record has; a feature without ``=`` means the key is present.

    Values compare as text, so a JSON ``true`` equals ``true``.
    """
    return _listed(matched, forbidden_values(settings), "record_id")


def missing_entries(entries: DataFrame, expected: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """A11 on long tables: (record_id, key) pairs expected but absent.

    ``keys`` names every key that can be expected; other entries are then skipped before the shuffle.
    """
    if keys is not None:
        entries = entries.where(F.col("key").isin(list(keys)))
    have = entries.select("record_id", "key").distinct()
    return expected.select("record_id", "key").join(have, ["record_id", "key"], "left_anti")


def _step_issues(step: Column, class_name: Column, status: Column) -> Column:
    field = F.concat(F.lit("transforms."), step)
    unknown = issue("warning", field, F.concat(F.lit("Unknown transform: "), class_name),
                    "This step may need a custom step")
    partial = issue("warning", field, F.concat(F.lit("Transform partially supported: "), class_name),
                    "Some settings may need manual adjustment")
    return F.when(status == "manual", unknown).when(status == "partial", partial)


def step_issues(classified: DataFrame) -> DataFrame:
    """A warning per classified step that is unknown or only partly supported."""
    found = _step_issues(F.col("step"), F.col("class"), F.col("status"))
    return _listed(classified, F.array_compact(F.array(found)), "record_id")


def with_issues(matched: DataFrame, step_catalog: DataFrame, settings: str = "settings") -> DataFrame:
    """Add ``steps`` (with status) and ``issues`` to every matched record.

    Steps meet a step catalog of any size in a join on their class and are gathered by ``record_id``, which must be unique.
    Only steps are shuffled for that; the other checks are row-local.
    """
    listed = matched.select("record_id", F.explode(documents.steps_of(F.col(settings))).alias("_step"))
    own = [f.name for f in listed.schema["_step"].dataType.fields]
    classified = catalog.classify_steps(listed.select("record_id", "_step.*"), step_catalog)
    gathered = classified.groupBy("record_id").agg(F.array_sort(
        F.collect_list(F.struct(*own, "status")), lambda x, y: x["pos"] - y["pos"]).alias("steps"))
    none = F.array().cast(gathered.schema["steps"].dataType)
    found = F.transform("steps", lambda s: _step_issues(s["step"], s["class"], s["status"]))
    return matched.join(gathered, "record_id", "left").withColumn("steps", F.coalesce("steps", none)).withColumn(
        "issues", F.concat(unknown_class(), missing_required(settings), forbidden_values(settings),
                           F.array_compact(found)))


def record_issues(audited: DataFrame) -> DataFrame:
    """The long issue table of ``with_issues``.

    Spark adds filters on the size of a bare column given to ``inline`` and pushes them below the checks, which would
    then run again for every filter. ``array_compact`` changes no value and keeps that from happening.
    """
    return _listed(audited, F.array_compact("issues"), "record_id")


def outcomes(audited: DataFrame, settings: str = "settings") -> DataFrame:
    """Result per record: status, errors, warnings, ``manual`` (a warning asks for manual work), ``has_secret``.

    Records with errors fail. All of it is row-local.
    """

    def having(severity: str) -> Column:
        return F.size(F.filter("issues", lambda i: i["severity"] == severity))

    secret = F.exists(F.map_keys(settings), lambda k: F.lower(k).rlike("password|secret"))
    manual = F.exists("issues", lambda i: F.lower(F.concat(i["message"], i["suggestion"])).contains("manual"))
    return audited.select(
        "record_id", "class", having("error").alias("errors"), having("warning").alias("warnings"),
        manual.alias("manual"), secret.alias("has_secret"),
    ).withColumn("status", F.when(F.col("errors") > 0, "failed").otherwise("success"))


# --- A28 ---------------------------------------------------------------------------------------------------

# Fixed values below: fields and messages of the document rules.

Rule = tuple[str, str, str, Column]  # severity, field, message, the condition that breaks the rule


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""


def version_ok(version: Column) -> Column:
    """One to three parts between dots."""
    return F.size(F.split(version, r"\.")) <= 3


def plugin_ok(plugin: Column) -> Column:
    """``kind:name`` or ``kind:name@version`` with a known kind."""
    return plugin.rlike(rf"\A(?:{'|'.join(values.PLUGIN_KINDS)}):[^:@]+(?:@[^:@]+)?\z")


def condition_ok(condition: Column) -> Column:
    return F.contains(F.regexp_replace(condition, r"\A!", ""), F.lit(":"))


def document_rules() -> list[Rule]:
    return [
        ("error", "version", "Version is required", _blank("version")),
        ("error", "version", "Invalid version", ~_blank("version") & ~version_ok(F.col("version"))),
        ("error", "pipelines", "At least one pipeline is required", F.col("n_pipelines") == 0),
    ]


def pipeline_rules(strict: bool = False) -> list[Rule]:
    rules = [
        ("error", "id", "Pipeline ID is required", _blank("id")),
        ("error", "name", "Pipeline name is required", _blank("name")),
        ("error", "status", "Invalid pipeline status",
         ~_blank("status") & ~F.col("status").isin(*values.PIPELINE_STATUSES)),
        ("error", "connectors", "Pipeline must have at least one connector", F.col("n_stages") == 0),
    ]
    if strict:
        rules.append(("warning", "description", "Pipeline description is recommended", _blank("description")))
    return rules


def stage_rules() -> list[Rule]:
    return [
        ("error", "id", "Connector ID is required", _blank("id")),
        ("error", "type", "Connector type is required", _blank("type")),
        ("error", "type", "Invalid connector type", ~_blank("type") & ~F.col("type").isin(*values.STAGE_TYPES)),
        ("error", "plugin", "Connector plugin is required", _blank("plugin")),
        ("error", "plugin", "Invalid plugin format", ~_blank("plugin") & ~plugin_ok(F.col("plugin"))),
        ("error", "name", "Connector name is required", _blank("name")),
    ]


def step_rules() -> list[Rule]:
    return [
        ("error", "id", "Processor ID is required", _blank("id")),
        ("error", "plugin", "Processor plugin is required", _blank("plugin")),
        ("error", "plugin", "Invalid plugin format", ~_blank("plugin") & ~plugin_ok(F.col("plugin"))),
        ("error", "condition", "Invalid condition syntax", ~_blank("condition") & ~condition_ok(F.col("condition"))),
    ]


def dead_letter_rules() -> list[Rule]:
    return [
        ("error", "plugin", "DLQ plugin is required", _blank("plugin")),
        ("error", "windowNackThreshold", "WindowNackThreshold cannot be greater than WindowSize",
         (F.col("window_size") > 0) & (F.col("nack_threshold") > F.col("window_size"))),
    ]


def check_rules(rows: DataFrame, rules: Sequence[Rule], *ids: str) -> DataFrame:
    """One issue per broken rule and row, in one pass over the rows."""
    broken = [F.when(breaks, issue(severity, field, message)) for severity, field, message, breaks in rules]
    return _listed(rows, F.array_compact(F.array(*broken)), *ids)


# --- A29, A30 ----------------------------------------------------------------------------------------------

def find_duplicates(rows: DataFrame, keys: Sequence[str], order: Sequence[str],
                    hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """Rows whose keys occurred earlier in ``order``.

    The first place of each repeated key is a partial aggregate; the rows meet it in a join that spreads hot keys, so
    no task holds a whole group.
    """
    first = (
        rows.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1").drop("_n")
    )
    return (
        skew.salted_join(rows, first, keys, "inner", hot_rows)
        .where(F.struct(*order) > F.col("_first")).drop("_first").select(*rows.columns)
    )


def duplicate_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A29 as counts: per repeated key, how many rows come after the first."""
    return rows.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("extra")).where("extra > 0")


def dangling_references(refs: DataFrame, target: str, ids: DataFrame, id_column: str,
                        hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """References whose target does not exist. Targets that many rows share are spread over tasks."""
    known = ids.select(F.col(id_column).cast(refs.schema[target].dataType).alias(target)).distinct()
    return skew.salted_join(refs, known, [target], "left_anti", hot_rows)


# --- A31 ---------------------------------------------------------------------------------------------------

def audit_capabilities(stages: DataFrame, capabilities: DataFrame, strict: bool = False, *ids: str,
                       settings: str = "settings") -> DataFrame:
    """Errors for missing required settings; in strict mode warnings for unknown ones.

    ``@version`` is removed from the plugin first. Keys starting with ``_`` are internal. A plugin without a capability
    row is only asked, in strict mode, to have settings at all.
    """
    s = F.col(settings)
    table = capabilities.withColumnRenamed("plugin", "_plugin")
    joined = skew.lookup(stages.withColumn("_plugin", F.split_part("plugin", F.lit("@"), F.lit(1))), table, ["_plugin"])
    lacking = F.filter("required", lambda k: ~F.map_contains_key(s, k))
    found = F.coalesce(F.transform(lacking, lambda k: issue(
        "error", k, F.concat(F.lit("Required setting missing: "), k))), F.array().cast(f"array<{ISSUE}>"))
    if strict:
        spare = F.filter(F.array_except(F.map_keys(s), F.concat("required", "optional")),
                         lambda k: ~F.startswith(k, F.lit("_")))
        unknown = F.transform(spare, lambda k: issue("warning", k, F.concat(F.lit("Unknown setting: "), k)))
        bare = F.when(F.size(s) == 0, F.array(issue("warning", "settings", "Connector has no settings configured")))
        extra = F.when(F.col("required").isNotNull(), unknown).otherwise(bare)
        found = F.concat(found, F.coalesce(extra, F.array().cast(f"array<{ISSUE}>")))
    return _listed(joined, found, *ids)


# --- A32, A33 ----------------------------------------------------------------------------------------------

def document_verdicts(documents: DataFrame, issues: DataFrame, doc_id: str = "doc_id", strict: bool = False) -> DataFrame:
    """Errors, warnings and verdict per document. Strict mode fails documents with warnings."""
    counts = issues.groupBy(doc_id).agg(F.count_if(F.col("severity") == "error").alias("errors"),
                                        F.count_if(F.col("severity") == "warning").alias("warnings"))
    verdict = (
        F.when(F.col("errors") > 0, "invalid")
        .when(F.col("warnings") > 0, "valid with warnings")
        .otherwise("valid")
    )
    passed = (F.col("errors") == 0) & (F.lit(not strict) | (F.col("warnings") == 0))
    return (
        documents.select(doc_id).join(counts, doc_id, "left")
        .na.fill(0, ["errors", "warnings"])
        .withColumn("verdict", verdict).withColumn("passed", passed)
    )


def verdict_counts() -> list[Column]:
    def count(*words: str) -> Column:
        return F.count_if(F.col("verdict").isin(*words))

    return [F.count(F.lit(1)).alias("total"), count("valid", "valid with warnings").alias("valid"),
            count("valid with warnings").alias("with_warnings"), count("invalid").alias("with_errors"),
            F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed")]


def validation_summary(verdicts: DataFrame) -> DataFrame:
    """Totals over all documents; a document with warnings only is also valid."""
    return verdicts.agg(*verdict_counts())


def select_records(heads: DataFrame, names: str | Sequence[str] = (), skip_unsupported: bool = False) -> DataFrame:
    """Records of the given names (all when none are given), optionally without unsupported ones."""
    wanted = [n.strip() for n in names.split(",") if n.strip()] if isinstance(names, str) else list(names)
    if wanted:
        heads = heads.where(F.col("name").isin(wanted))
    return heads.where(F.col("status") != "unsupported") if skip_unsupported else heads
