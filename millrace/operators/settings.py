"""Settings of records: A7, A22, A26, A27, A36. All row-local once a lookup row has joined the record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import maps, text, values
from millrace.operators import skew

URL = "schema.registry.url"
KEY_URL = "key.converter.schema.registry.url"
VALUE_URL = "value.converter.schema.registry.url"


# --- A7, A22 -----------------------------------------------------------------------------------------------

def with_worker(records: DataFrame, workers: DataFrame, on: str = "group", out: str = "worker_settings") -> DataFrame:
    """Join each record with the settings of its worker. Many records share a worker, so the lookup spreads them."""
    table = workers.select(on, F.col("settings").alias(out))
    return skew.lookup(records, table, [on], "left")


def resolve_registry(records: DataFrame, settings: str = "settings", worker: str = "worker_settings") -> DataFrame:
    """Add ``registry_url`` and ``registry_settings``.

    The URL is the first non-empty of the worker's own, key and value URL, then the record's key and value URL. Other
    keys holding ``schema.registry`` are collected, those of the record over those of the worker.
    """
    mine, shared = F.col(settings), F.coalesce(F.col(worker), F.create_map().cast("map<string,string>"))

    def related(found: Column, *known: str) -> Column:
        return F.map_filter(found, lambda k, v: F.contains(k, F.lit("schema.registry")) & ~k.isin(*known))

    return records.withColumns({
        "registry_url": F.coalesce(maps.first_filled(shared, [URL, KEY_URL, VALUE_URL]),
                                   maps.first_filled(mine, [KEY_URL, VALUE_URL]), F.lit("")),
        "registry_settings": maps.overlay(related(shared, URL), related(mine, KEY_URL, VALUE_URL)),
    })


GLOBAL_KEYS = (URL, "security.protocol")


def apply_globals(records: DataFrame, settings: str = "settings", worker: str = "worker_settings") -> DataFrame:
    """The worker's registry URL and security protocol override each record's; converters are not passed on."""
    shared = F.map_filter(F.coalesce(F.col(worker), F.create_map().cast("map<string,string>")),
                          lambda k, v: k.isin(*GLOBAL_KEYS) & (v != ""))
    return records.withColumn(settings, maps.overlay(F.col(settings), shared))


# --- A26, A27 ----------------------------------------------------------------------------------------------

def find_sensitive_keys(entries: DataFrame) -> DataFrame:
    """Entries whose key names a secret."""
    return entries.where(text.is_sensitive(F.col("key")))


def _hidden(key: Column, value: Column) -> Column:
    return F.when(text.is_sensitive(key), text.masked(key, value)).otherwise(value)


def mask_secrets(entries: DataFrame) -> DataFrame:
    """Values of sensitive keys become placeholders; ``${...}`` references stay."""
    return entries.withColumn("value", _hidden(F.col("key"), F.col("value")))


def mask_settings(records: DataFrame, settings: str = "settings") -> DataFrame:
    """A26 on the settings of whole records, without a row per setting."""
    return records.withColumn(settings, F.transform_values(settings, _hidden))


# --- A36 ---------------------------------------------------------------------------------------------------

def is_runtime_key(key: Column, prefixes: Sequence[str] = values.RUNTIME_PREFIXES) -> Column:
    return maps.starts_with_any(key, prefixes) | key.isin(*values.RUNTIME_KEYS)


def carry_over(records: DataFrame, settings: str = "settings", raw: str | None = None,
               prefixes: Sequence[str] = values.RUNTIME_PREFIXES, out: str = "carried") -> DataFrame:
    """Settings without runtime-specific keys; with ``raw``, keys only present there fill the gaps."""
    kept = F.map_filter(settings, lambda k, v: ~is_runtime_key(k, prefixes))
    return records.withColumn(out, kept if raw is None else maps.overlay(F.col(raw), kept))
