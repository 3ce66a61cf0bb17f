"""Row-local work on setting maps. Nothing here shuffles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

BLANKS = " \t\r\n\f\u000b"


def trimmed(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def listed(text: Column) -> Column:
    """Comma text to a list: trimmed, without blanks."""
    return F.filter(F.transform(F.split(text, ","), trimmed), lambda x: x != "")


def filled(col: Column) -> Column:
    """The text, or null when it is empty."""
    return F.nullif(col, F.lit(""))


def bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once, however often ``fn`` uses it."""
    return F.transform(F.array(value), fn)[0]


def distinct_keys(found: Column) -> Column:
    """A parsed map whose text may have repeated a key; of a repeated key the last value stays."""
    keys = F.map_keys(found)
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), last_wins(F.map_entries(found))).otherwise(found)


def last_wins(pairs: Column) -> Column:
    """Map from an array of (key, value) structs; of a repeated key the last value stays.

    Sorting by key and place makes this n log n; a duplicate key would otherwise stop the job.
    """
    placed = F.transform(pairs, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("value")))

    def pick(rows: Column) -> Column:
        last = F.filter(rows, lambda e, i: ~e["key"].eqNullSafe(F.get(rows, i + 1)["key"]))
        return F.transform(last, lambda e: F.struct(e["key"], e["value"]))

    return F.map_from_entries(bind(F.array_sort(placed), pick))


def overlay(base: Column, top: Column) -> Column:
    """Map ``base`` with the keys of ``top`` added or replaced."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(top, k)), top)


def scoped(settings: Column, prefix: str) -> Column:
    """Settings whose key has the prefix, with the prefix removed."""
    inside = F.map_filter(settings, lambda k, v: F.startswith(k, F.lit(prefix)) & (F.length(k) > len(prefix)))
    return F.transform_keys(inside, lambda k, v: F.substr(k, F.lit(len(prefix) + 1)))


def first_filled(settings: Column, keys: Sequence[str]) -> Column:
    return F.coalesce(*[filled(settings[k]) for k in keys])


def starts_with_any(col: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for prefix in prefixes:
        out = out | F.startswith(col, F.lit(prefix))
    return out


def contains_any(col: Column, parts: Sequence[str]) -> Column:
    out = F.lit(False)
    for part in parts:
        out = out | F.contains(col, F.lit(part))
    return out
