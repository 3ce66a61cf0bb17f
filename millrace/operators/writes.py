"""Write modes W1-W8 and schema evolution W15, as joins between a target table and a batch of rows.

These give the whole new table as a plan; ``slices`` has the same modes for a stored table of which only the touched parts are rewritten.
Whole rows replace the target's by an anti join and a union, so a small batch is broadcast and the target stays in place; the modes
that mix old and new values of a row join the two sides. Keys identify a row. A batch that repeats a key is reduced by its ``order`` to the last row
per key, by an aggregate that is partial before the shuffle; rows without a key match nothing and are added as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators import steps


def write_insert(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Append."""
    return target.unionByName(rows)


def _merge(target: DataFrame, rows: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Target and rows side by side: ``_t`` and ``_r`` hold the two versions, null when absent."""
    left = target.select(*keys, F.struct(*target.columns).alias("_t"))
    right = rows.select(*keys, F.struct(*rows.columns).alias("_r"))
    return left.join(right, list(keys), how)


def _chosen(target: DataFrame, rows: DataFrame) -> list[Column]:
    """Per target column: the new value where a row arrived and carries the column, else the old value."""
    out = []
    for name in target.columns:
        old = F.col(f"_t.{name}")
        if name in rows.columns:
            out.append(F.when(F.col("_r").isNotNull(), F.col(f"_r.{name}")).otherwise(old).alias(name))
        else:
            out.append(old.alias(name))
    return out


def write_update(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Change rows whose key exists; other incoming rows are ignored. Of rows that repeat a key the last by ``order`` counts."""
    rows = last_per_key(rows, keys, order) if order else rows
    return _merge(target, rows, keys, "left").select(*_chosen(target, rows))


def write_upsert(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """W3, the default mode: change existing keys, add new ones.

    Rows with all columns replace the target's by an anti join on their keys, so a small batch is broadcast and the target isn't
    shuffled. Where a column is missing the old value is kept, which takes a full join. Of rows that repeat a key the last by
    ``order`` counts.
    """
    rows = last_per_key(rows, keys, order) if order else rows
    if set(target.columns) <= set(rows.columns):
        kept = target.join(rows.select(*keys).distinct(), list(keys), "left_anti").select(*target.columns)
        return kept.unionByName(rows.select(*target.columns))
    return _merge(target, rows, keys, "full").select(*_chosen(target, rows))


def write_delete(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove the given keys. Repeated keys are dropped before the join."""
    return target.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def write_mode(target: DataFrame, rows: DataFrame, keys: Sequence[str], mode: str | None = None) -> DataFrame:
    """The mode by name; missing or unknown text means upsert."""
    if mode == "insert":
        return write_insert(target, rows)
    if mode == "update":
        return write_update(target, rows, keys)
    return write_upsert(target, rows, keys)


# --- W5 ----------------------------------------------------------------------------------------------------

def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    The aggregate is partial before the shuffle, so a key with a third of all rows sends one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)


def apply_changes(target: DataFrame | None, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Fold change records (op, before, after, order columns) into the target.

    The last change of each key wins: ``d`` removes the row, anything else inserts or replaces it. With no target the
    result is the state the changes alone describe. ``keys`` are fields of the row image.
    """
    state = steps.unwrap_cdc(changes, drop_tombstones=True)
    last = last_per_key(state, keys, order)
    if target is None:
        return last.where(~F.col("__deleted")).drop("__deleted", *[c for c in order if c not in _row(changes)])
    rows = last.select(*[c for c in last.columns if c in target.columns or c == "__deleted"])
    merged = _merge(target, rows, keys, "full").where(~F.coalesce(F.col("_r.__deleted"), F.lit(False)))
    return merged.select(*_chosen(target, rows))


def _row(changes: DataFrame) -> list[str]:
    return [f.name for f in changes.schema["after"].dataType.fields]


# --- W6 ----------------------------------------------------------------------------------------------------

def resolve_keys(df: DataFrame, pk_mode: str | None, pk_fields: str = "", key: str = "key",
                 value: str = "value") -> tuple[DataFrame, list[str]]:
    """Which columns identify a row, by mode.

    ``kafka``: topic, partition, offset. ``record_key``: fields of the key struct (all, or ``pk_fields``).
    ``record_value``: ``pk_fields`` of the value struct. ``none`` or missing: no key.
    """
    fields = [f.strip() for f in pk_fields.split(",") if f.strip()]
    if pk_mode == "kafka":
        return df, fields or ["topic", "partition", "offset"]
    if pk_mode == "record_key":
        fields = fields or [f.name for f in df.schema[key].dataType.fields]
        return df.withColumns({f: F.col(f"{key}.{f}") for f in fields}), fields
    if pk_mode == "record_value":
        if not fields:
            raise ValueError("pk.mode=record_value needs pk.fields")
        return df.withColumns({f: F.col(f"{value}.{f}") for f in fields}), fields
    if pk_mode in (None, "", "none"):
        return df, []
    raise ValueError(f"unknown pk.mode {pk_mode!r}")


# --- W7 ----------------------------------------------------------------------------------------------------

# Public class names of the document id strategies.
ID_STRATEGIES = {
    "com.mongodb.kafka.connect.sink.processor.id.strategy.BsonOidStrategy": "bson_objectid",
    "com.mongodb.kafka.connect.sink.processor.id.strategy.UuidStrategy": "uuid",
    "com.mongodb.kafka.connect.sink.processor.id.strategy.ProvidedInKeyStrategy": "provided_in_key",
    "com.mongodb.kafka.connect.sink.processor.id.strategy.ProvidedInValueStrategy": "provided_in_value",
    "com.mongodb.kafka.connect.sink.processor.id.strategy.PartialKeyStrategy": "partial_key",
    "com.mongodb.kafka.connect.sink.processor.id.strategy.PartialValueStrategy": "partial_value",
}


def id_strategy(class_name: str) -> str:
    return ID_STRATEGIES.get(class_name, "bson_objectid")


def assign_document_id(df: DataFrame, strategy: str = "bson_objectid", fields: Sequence[str] = (), key: str = "key",
                       value: str = "value", out: str = "_id") -> DataFrame:
    """Give each record a document id.

    The object id is 24 hex digits of a digest of ``fields`` (default: the whole value), so a rerun gives the same id.
    """
    if strategy == "uuid":
        new = F.uuid()
    elif strategy == "provided_in_key":
        new = F.col(f"{key}.id").cast("string")
    elif strategy == "provided_in_value":
        new = F.col(f"{value}.id").cast("string")
    elif strategy in ("partial_key", "partial_value"):
        holder = key if strategy == "partial_key" else value
        new = F.to_json(F.struct(*[F.col(f"{holder}.{f}").alias(f) for f in fields]))
    else:
        # As JSON with nulls kept, so neighbouring fields cannot run together.
        parts = F.struct(*[F.col(f).cast("string").alias(f"f{k}") for k, f in enumerate(fields)])
        text = F.to_json(parts, {"ignoreNullFields": "false"}) if fields else F.to_json(value)
        new = F.substring(F.sha2(text, 256), 1, 24)
    return df.withColumn(out, new)


# --- W8 ----------------------------------------------------------------------------------------------------

# Public class-name parts of the write models, in the order they are tried.
WRITE_MODELS = (
    ("ReplaceOneDefaultStrategy", "replace_one"),
    ("ReplaceOneBusinessKeyStrategy", "replace_one_business_key"),
    ("DeleteOneDefaultStrategy", "delete_one"),
    ("UpdateOneTimestampsStrategy", "update_one_timestamps"),
    ("InsertOneDefaultStrategy", "insert_one"),
)


def write_model_name(class_name: str) -> str:
    return next((model for part, model in WRITE_MODELS if part in class_name), "replace_one")


def write_model(target: DataFrame, rows: DataFrame, keys: Sequence[str], model: str = "replace_one",
                business_keys: Sequence[str] = (), now: Column | None = None) -> DataFrame:
    """Apply ``rows`` under a document write model.

    ``update_one_timestamps`` keeps ``inserted_ts`` of an existing document and sets ``modified_ts`` on every written one.
    """
    if model == "insert_one":
        return write_insert(target, rows)
    if model == "delete_one":
        return write_delete(target, rows, keys)
    if model == "replace_one_business_key":
        return write_upsert(target, rows, business_keys or keys)
    if model == "update_one_timestamps":
        now = F.current_timestamp() if now is None else now
        merged = _merge(target, rows, keys, "full")
        plain = [c for c in target.columns if c not in ("inserted_ts", "modified_ts")]
        written = F.col("_r").isNotNull()
        stamps = [
            F.when(written, F.coalesce("_t.inserted_ts", now)).otherwise(F.col("_t.inserted_ts")).alias("inserted_ts"),
            F.when(written, now).otherwise(F.col("_t.modified_ts")).alias("modified_ts"),
        ]
        return merged.select(*_chosen(target.select(*plain), rows), *stamps)
    return write_upsert(target, rows, keys)


# --- W15 ---------------------------------------------------------------------------------------------------

def evolve_schema(target: DataFrame | None, rows: DataFrame, auto_create: bool = False,
                  auto_evolve: bool = False) -> tuple[DataFrame, DataFrame]:
    """(target, rows) under one schema, ready for any write mode.

    A missing target is created empty with the schema of ``rows``; new columns are added to the target as nulls.
    Either needs its flag. Columns missing from ``rows`` are filled with nulls.
    """
    if target is None:
        if not auto_create:
            raise ValueError("target does not exist and auto.create is off")
        return rows.limit(0), rows
    added = [f for f in rows.schema.fields if f.name not in target.columns]
    if added and not auto_evolve:
        raise ValueError(f"new columns {[f.name for f in added]} and auto.evolve is off")
    for f in added:
        target = target.withColumn(f.name, F.lit(None).cast(f.dataType))
    for f in target.schema.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
        elif rows.schema[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} changes type from {f.dataType} to {rows.schema[f.name].dataType}")
    return target, rows.select(*target.columns)
