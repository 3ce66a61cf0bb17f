"""Scalar text functions: A14, A26, A27, A38, A39."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions import maps, values


# --- A14 ---------------------------------------------------------------------------------------------------

def kind(class_name: Column) -> Column:
    """source, sink or unknown."""
    name = F.lower(class_name)
    return (
        F.when(maps.contains_any(name, ("source", "debezium")), "source")
        .when(F.contains(name, F.lit("sink")), "sink")
        .otherwise("unknown")
    )


def direction(class_name: Column) -> Column:
    """source or destination, with extended word lists; source when nothing fits."""
    name = F.lower(class_name)
    return (
        F.when(F.contains(name, F.lit("source")), "source")
        .when(F.contains(name, F.lit("sink")), "destination")
        .when(maps.contains_any(name, values.SOURCE_PARTS), "source")
        .when(maps.contains_any(name, values.DESTINATION_PARTS), "destination")
        .otherwise("source")
    )


# --- A26, A27 ----------------------------------------------------------------------------------------------

def is_sensitive(key: Column) -> Column:
    return F.lower(key).rlike("|".join(values.SENSITIVE_PARTS))


def masked(key: Column, value: Column) -> Column:
    """The value if it is a ``${...}`` reference, else a placeholder named after the key."""
    reference = F.startswith(value, F.lit("${")) & F.endswith(value, F.lit("}"))
    return F.when(reference, value).otherwise(F.concat(F.lit("${MASKED_"), F.upper(key), F.lit("}")))


# --- A38 ---------------------------------------------------------------------------------------------------

_STANDARD = r"^(?:([^/?#]*)@)?(\[[^\]]*\]|[^:/?#]*)(?::([^/?#]*))?(?:/([^?#]*))?(?:\?([^#]*))?(?:#.*)?$"


def _pairs(text: Column, separator: str) -> Column:
    """``k=v`` parts to a map; parts without exactly one ``=`` are skipped, the first of a repeated key stays."""
    parts = F.transform(F.split(text, separator), lambda p: F.split(p, "="))
    kept = F.filter(parts, lambda p: (F.size(p) == 2) & (maps.trimmed(p[0]) != ""))
    return F.transform(kept, lambda p: F.struct(maps.trimmed(p[0]).alias("key"), maps.trimmed(p[1]).alias("value")))


def _decoded_pairs(text: Column) -> Column:
    return F.transform(_pairs(text, "&"), lambda e: F.struct(
        F.coalesce(F.try_url_decode(e["key"]), e["key"]).alias("key"),
        F.coalesce(F.try_url_decode(e["value"]), e["value"]).alias("value")))


def connection_url(url: Column) -> Column:
    """Parts of a ``jdbc:`` URL: protocol, host, port, database, user, password, params, family, error.

    Both ``host:port/database?k=v`` and ``host:port;databaseName=d;k=v`` are read. A parameter named like a part
    (``user``, ``password``, ...) overrides it. A URL that cannot be read has only ``error``.
    """
    protocol = maps.filled(F.regexp_extract(url, r"^jdbc:([^/]+)://", 1))
    rest = F.regexp_extract(url, r"(?s)^jdbc:[^/]+://(.*)$", 1)
    semicolons = F.contains(rest, F.lit(";"))

    def standard(group: int) -> Column:
        return maps.filled(F.regexp_extract(rest, _STANDARD, group))

    def decoded(col: Column) -> Column:
        return F.coalesce(F.try_url_decode(F.replace(col, F.lit("+"), F.lit("%2B"))), col)

    userinfo = standard(1)
    address = F.split_part(rest, F.lit(";"), F.lit(1))
    colon = address.rlike(r"^.+:[^:]*$")
    tail = F.regexp_extract(rest, r"(?s)^[^;]*;(.*)$", 1)
    empty = F.array().cast("array<struct<key:string,value:string>>")
    # Query strings keep the first of a repeated key, the ``;`` form the last.
    params = maps.last_wins(F.when(semicolons, _pairs(tail, ";")).otherwise(
        F.coalesce(F.reverse(_decoded_pairs(standard(5))), empty)))

    parts = {
        "host": F.when(semicolons, F.when(colon, F.regexp_extract(address, r"^(.*):[^:]*$", 1)).otherwise(address))
        .otherwise(F.regexp_replace(standard(2), r"^\[|\]$", "")),
        "port": F.when(semicolons, F.when(colon, F.regexp_extract(address, r":([^:]*)$", 1))).otherwise(standard(3)),
        "database": F.when(~semicolons, decoded(standard(4))),
        "user": F.when(~semicolons, decoded(F.split_part(userinfo, F.lit(":"), F.lit(1)))),
        "password": F.when(~semicolons, decoded(maps.filled(F.regexp_extract(userinfo, r"^[^:]*:(.*)$", 1)))),
    }
    error = (
        F.when(url.isNull() | ~F.startswith(url, F.lit("jdbc:")), "must start with jdbc:")
        .when(protocol.isNull(), "missing protocol")
        .when(~semicolons & ~rest.rlike(_STANDARD), "malformed address")
        .when(~semicolons & standard(3).isNotNull() & ~standard(3).rlike(r"^\d+$"), "invalid port")
    )
    family = F.lit(None).cast("string")
    for name, group in values.DATABASE_FAMILIES.items():
        family = F.when(protocol == name, group).otherwise(family)

    def build(found: Column) -> Column:
        # ``databaseName`` names the database only in the ``;`` form.
        renamed = F.when(semicolons, found["databaseName"])
        fields = {n: F.coalesce(found[n], renamed, c) if n == "database" else F.coalesce(found[n], c)
                  for n, c in parts.items()}
        others = F.map_filter(found, lambda k, v: ~(k.isin(*parts) | (semicolons & (k == "databaseName"))))
        return F.struct(protocol.alias("protocol"), *[c.alias(n) for n, c in fields.items()],
                        family.alias("family"), others.alias("params"))

    good = maps.bind(params, build)
    return F.struct(F.when(error.isNull(), good).alias("parts"), error.alias("error"))


# --- A39 ---------------------------------------------------------------------------------------------------

def identifier(name: Column) -> Column:
    """Lower-case id of letters, digits and ``-``; ``pipeline`` when nothing is left."""
    plain = F.regexp_replace(F.translate(F.lower(name), " _.", "---"), "[^a-z0-9-]", "")
    return F.coalesce(maps.filled(F.btrim(plain, F.lit("-"))), F.lit("pipeline"))


def file_identifier(name: Column) -> Column:
    """Path-safe id: separators and reserved characters become ``-``."""
    return F.lower(F.translate(name, ' /\\:*?"<>|.', "-----------"))


def command_identifier(name: Column) -> Column:
    """File id with ``p`` put before a leading digit."""
    plain = file_identifier(name)
    return F.when(plain.rlike("^[0-9]"), F.concat(F.lit("p"), plain)).otherwise(plain)


def generator_identifier(name: Column) -> Column:
    """Separators become ``-``, reserved characters vanish, ``p`` goes before anything but a leading letter."""
    plain = F.lower(F.translate(name, ' ./\\:*?"<>|', "-----"))
    return F.when(plain.rlike("^[^a-z]"), F.concat(F.lit("p"), plain)).otherwise(plain)
