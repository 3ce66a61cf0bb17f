"""Per-record steps T1-T14. All run the same on batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from millrace.operators.changes import Change, Step, apply


# --- T1, T12 -----------------------------------------------------------------------------------------------

def _whole(regex: str) -> str:
    return rf"\A(?:{regex})\z"


def regex_route(regex: str, replacement: str, topic: str = "topic") -> Step:
    """Rewrite a topic whose whole name matches; other topics stay."""
    return lambda df: Change({topic: F.regexp_replace(topic, _whole(regex), replacement)})


def route_regex(df: DataFrame, regex: str, replacement: str, topic: str = "topic") -> DataFrame:
    return apply(df, regex_route(regex, replacement, topic))


def logical_table(regex: str, replacement: str, key: str = "key", shard: str = "shard",
                  topic: str = "topic") -> Step:
    """Merge sharded tables into one topic; the old topic joins the key so keys stay unique."""

    def step(df: DataFrame) -> Change:
        matches = F.col(topic).rlike(_whole(regex))
        fields = [F.col(f"{key}.{f.name}").alias(f.name) for f in df.schema[key].dataType.fields]
        return Change({
            topic: F.regexp_replace(topic, _whole(regex), replacement),
            key: F.struct(F.when(matches, F.col(topic)).alias(shard), *fields),
        })

    return step


def route_logical_table(df: DataFrame, regex: str, replacement: str, key: str = "key", shard: str = "shard",
                        topic: str = "topic") -> DataFrame:
    return apply(df, logical_table(regex, replacement, key, shard, topic))


# --- T2 ----------------------------------------------------------------------------------------------------

def timestamp_to(field: str, target: str, fmt: str = "yyyy-MM-dd HH:mm:ss", out: str | None = None) -> Step:
    """Convert between timestamp, date, milliseconds of the day (``time``), epoch milliseconds (``unix``) and text (``string``)."""

    def step(df: DataFrame) -> Change:
        kind, source = df.schema[field].dataType, F.col(field)
        if isinstance(kind, T.StringType):
            moment = F.try_to_timestamp(source, F.lit(fmt))
        elif isinstance(kind, (T.LongType, T.IntegerType)):
            moment = F.timestamp_millis(source)
        else:
            moment = source.cast("timestamp")
        results = {
            "timestamp": moment,
            "date": F.to_date(moment),
            "time": (F.pmod(F.unix_millis(moment), F.lit(86_400_000))).cast("int"),
            "unix": F.unix_millis(moment),
            "string": F.date_format(moment, fmt),
        }
        if target not in results:
            raise ValueError(f"unknown target {target!r}; use one of {sorted(results)}")
        return Change({out or field: results[target]})

    return step


def convert_timestamp(df: DataFrame, field: str, target: str, fmt: str = "yyyy-MM-dd HH:mm:ss",
                      out: str | None = None) -> DataFrame:
    return apply(df, timestamp_to(field, target, fmt, out))


# --- T3, T4, T5 --------------------------------------------------------------------------------------------

def inserted(name: str, value: object = None, meta: str | None = None) -> Step:
    """Add a constant, or a copy of a metadata column such as ``topic``, ``ts``, ``offset``, ``partition``."""
    return lambda df: Change({name: F.col(meta) if meta else F.lit(value)})


def insert_field(df: DataFrame, name: str, value: object = None, meta: str | None = None) -> DataFrame:
    return apply(df, inserted(name, value, meta))


def replaced(include: Sequence[str] = (), exclude: Sequence[str] = (),
             renames: Mapping[str, str] | None = None) -> Step:
    """Keep, drop and rename fields. A dotted name drops a field inside a struct."""

    def step(df: DataFrame) -> Change:
        put: dict[str, Column] = {}
        drop = {c for c in df.columns if c in exclude or (include and c not in include)}
        nested: dict[str, list[str]] = {}
        for name in exclude:
            head, dot, rest = name.partition(".")
            if dot and head in df.columns and name not in df.columns:
                nested.setdefault(head, []).append(rest)
        for head, fields in nested.items():
            put[head] = F.col(head).dropFields(*fields)
        for old, new in (renames or {}).items():
            if old in df.columns and old not in drop:
                put[new] = put.pop(old, F.col(old))
                drop.add(old)
        return Change(put, tuple(c for c in drop if c not in put))

    return step


def replace_field(df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = (),
                  renames: Mapping[str, str] | None = None) -> DataFrame:
    return apply(df, replaced(include, exclude, renames))


def _blank(kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.DateType):
        return F.lit("1970-01-01").cast(kind)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    return F.lit(None).cast(kind)


def masked(fields: str | Sequence[str], replacement: str | None = None) -> Step:
    """Replace fields by an empty value of their type, or by a constant. ``fields`` may be comma text."""
    names = fields.split(",") if isinstance(fields, str) else list(fields)

    def step(df: DataFrame) -> Change:
        kinds = {n: df.schema[n].dataType for n in names}
        return Change({n: _blank(k) if replacement is None else F.lit(replacement).cast(k)
                       for n, k in kinds.items()})

    return step


def mask_field(df: DataFrame, fields: str | Sequence[str], replacement: str | None = None) -> DataFrame:
    return apply(df, masked(fields, replacement))


# --- T6, T7 ------------------------------------------------------------------------------------------------

def _condition(condition: Column | str) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def filtered(condition: Column | str | None = None) -> Step:
    """Drop records the condition matches; with no condition, drop every record the predicate lets through."""
    hit = F.lit(True) if condition is None else F.coalesce(_condition(condition), F.lit(False))
    return lambda df: Change(keep=~hit)


def filter_records(df: DataFrame, condition: Column | str) -> DataFrame:
    return apply(df, filtered(condition))


def predicate_text(name: str, negate: bool = False) -> str:
    return ("!" if negate else "") + f"predicate:{name}"


def resolve_predicate(text: str, predicates: Mapping[str, Column | str]) -> Column:
    """Column for ``predicate:NAME`` or ``!predicate:NAME``; a null predicate is false before ``!`` applies."""
    name = text.removeprefix("!").removeprefix("predicate:")
    if name not in predicates:
        raise KeyError(f"unknown predicate {name!r}")
    holds = F.coalesce(_condition(predicates[name]), F.lit(False))
    return ~holds if text.startswith("!") else holds


def when_predicate(df: DataFrame, step: Step, predicate: Column | str, negate: bool = False) -> DataFrame:
    """Run ``step`` only on records where ``predicate`` holds (or does not hold, with ``negate``)."""
    holds = F.coalesce(_condition(predicate), F.lit(False))
    return apply(df, step, ~holds if negate else holds)


# --- T8, T9, T10, T11 --------------------------------------------------------------------------------------

# Type names of connector configs that Spark spells differently.
CAST_TYPES = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "float32": "float",
              "float64": "double"}


def cast_to(spec: str | Mapping[str, str]) -> Step:
    """``field:type`` pairs; a value that does not fit becomes null (ANSI mode would fail the job)."""
    pairs = dict(p.strip().split(":", 1) for p in spec.split(",")) if isinstance(spec, str) else dict(spec)
    return lambda df: Change({f: F.col(f).try_cast(CAST_TYPES.get(t.strip(), t.strip())) for f, t in pairs.items()})


def cast_fields(df: DataFrame, spec: str | Mapping[str, str]) -> DataFrame:
    return apply(df, cast_to(spec))


def extracted(field: str, column: str = "value") -> Step:
    """Replace a struct column by one of its fields."""
    return lambda df: Change({column: F.col(f"{column}.{field}")})


def extract_field(df: DataFrame, field: str, column: str = "value") -> DataFrame:
    return apply(df, extracted(field, column))


def flattened(delimiter: str = ".", columns: Sequence[str] | None = None, but: Sequence[str] = ()) -> Step:
    """Turn nested structs (``columns``, or all but ``but``) into top-level columns; maps and arrays stay whole."""

    def leaves(prefix: Column, name: str, kind: T.DataType) -> list[tuple[str, Column]]:
        if not isinstance(kind, T.StructType):
            return [(name, prefix)]
        return [leaf for f in kind.fields
                for leaf in leaves(prefix.getField(f.name), name + delimiter + f.name, f.dataType)]

    def step(df: DataFrame) -> Change:
        roots = [f for f in df.schema.fields if isinstance(f.dataType, T.StructType)
                 and (f.name not in but if columns is None else f.name in columns)]
        put = {name: col for f in roots for name, col in leaves(F.col(f.name), f.name, f.dataType)}
        return Change(put, tuple(f.name for f in roots))

    return step


def flatten(df: DataFrame, delimiter: str = ".", columns: Sequence[str] | None = None) -> DataFrame:
    return apply(df, flattened(delimiter, columns))


def unwrapped(drop_tombstones: bool = True) -> Step:
    """Change envelope (op, before, after) to row state. ``d`` gives the old row with ``__deleted``.

    A record with neither image is a tombstone: dropped, or kept with empty fields.
    """

    def step(df: DataFrame) -> Change:
        deleted = F.coalesce(F.col("op") == "d", F.lit(False))
        fields = [f.name for f in df.schema["after"].dataType.fields]
        put = {f: F.when(deleted, F.col(f"before.{f}")).otherwise(F.col(f"after.{f}")) for f in fields}
        put["__deleted"] = deleted
        image = F.when(deleted, F.col("before").isNotNull()).otherwise(F.col("after").isNotNull())
        return Change(put, ("op", "before", "after"), image if drop_tombstones else None)

    return step


def unwrap_cdc(df: DataFrame, drop_tombstones: bool = True) -> DataFrame:
    return apply(df, unwrapped(drop_tombstones))


# --- T13, T14 ----------------------------------------------------------------------------------------------

def _flag(settings: Mapping[str, str], key: str, default: bool) -> bool:
    return str(settings.get(key, default)).lower() in ("1", "t", "true")


def _names(settings: Mapping[str, str], *keys: str) -> list[str]:
    text = next((settings[k] for k in keys if settings.get(k)), "")
    return [n.strip() for n in text.split(",") if n.strip()]


def _insert_settings(s: Mapping[str, str], side: str | None) -> Step:
    """All fields that the settings name, in one change: on the record, or under ``$Key`` in its key, from the record's columns."""
    put = {s[meta]: F.col(column) for meta, column in (("topic.field", "topic"), ("timestamp.field", "ts"),
                                                       ("offset.field", "offset"), ("partition.field", "partition")) if meta in s}
    if "static.field" in s:
        put[s["static.field"]] = F.lit(s.get("static.value"))
    if not put:
        raise ValueError("InsertField names no field")
    if side != "Key":
        return lambda df: Change(dict(put))
    key = F.col("key")
    for name, value in put.items():
        key = key.withField(f"`{name}`", value)
    return lambda df: Change({"key": key})


def _flatten_settings(s: Mapping[str, str], side: str | None) -> Step:
    """``$Key`` flattens the key alone, ``$Value`` all but the key."""
    return flattened(s.get("delimiter", "."), ["key"] if side == "Key" else None, ["key"] if side == "Value" else ())


# Step classes of the public connector framework, without package and $Key/$Value suffix.
STEP_CLASSES: dict[str, Callable[..., Step]] = {
    "RegexRouter": lambda s: regex_route(s["regex"], s["replacement"]),
    "TimestampConverter": lambda s: timestamp_to(
        s["field"], s.get("target.type", "timestamp").lower(), s.get("format", "yyyy-MM-dd HH:mm:ss")),
    "InsertField": _insert_settings,
    "ReplaceField": lambda s: replaced(
        _names(s, "include", "whitelist"), _names(s, "exclude", "blacklist"),
        dict(p.split(":", 1) for p in _names(s, "renames"))),
    "MaskField": lambda s: masked(_names(s, "fields"), s.get("replacement")),
    "Filter": lambda s: filtered(s.get("condition")),
    "Cast": lambda s: cast_to(s["spec"]),
    "ExtractField": lambda s, side: extracted(s["field"], "key" if side == "Key" else "value"),
    "Flatten": _flatten_settings,
    "ExtractNewRecordState": lambda s: unwrapped(_flag(s, "drop.tombstones", True)),
    "ByLogicalTableRouter": lambda s: logical_table(s["topic.regex"], s["topic.replacement"],
                                                    shard=s.get("key.field.name", "shard")),
}

#: Step classes that know the sides of a record themselves.
SIDED = ("ExtractField", "Flatten", "InsertField")
#: Step classes that change the fields of a record, of its key under ``$Key`` and of its value under ``$Value``.
FIELD_STEPS = ("TimestampConverter", "ReplaceField", "MaskField", "Cast")

_custom: dict[str, Callable[[DataFrame], DataFrame]] = {}


def step_name(class_name: str) -> str:
    return class_name.rsplit(".", 1)[-1].split("$", 1)[0]


def step_side(class_name: str) -> str | None:
    """``Key`` or ``Value`` of a class name's suffix."""
    return class_name.rsplit("$", 1)[1] if "$" in class_name else None


def custom_step(class_name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Register a user step. ``fn`` may use any DataFrame operation, pandas UDFs and ``mapInPandas`` included."""
    _custom[class_name] = fn


def one_to_many(fn: Callable[[Row], Iterable[tuple]], schema: str, keep: Sequence[str] = ()) -> Callable[[DataFrame], DataFrame]:
    """A custom step that gives none, one or several records for each, as a Python table function.

    ``fn`` gets a record as a ``Row`` and yields tuples of ``schema``; the new records carry the columns ``keep`` of the old one. It is
    a lateral join, so it runs on streams too, and a task holds one record's output at a time.
    """

    class Records:
        def eval(self, record: Row) -> Iterable[tuple]:
            yield from fn(record)

    table = F.udtf(Records, returnType=schema)
    names = [f.name for f in T.StructType.fromDDL(schema).fields]

    def step(df: DataFrame) -> DataFrame:
        whole = df.select(*[F.col(c).alias(f"_kept_{c}") for c in keep], F.struct(*df.columns).alias("_record"))
        made = whole.lateralJoin(table(F.col("_record").outer()))
        return made.select(*[F.col(f"_kept_{c}").alias(c) for c in keep], *names)

    return step


def within(df: DataFrame, side: str, step: Step, holds: Column | None = None) -> DataFrame:
    """Run a step on the fields of the struct column ``side`` instead of those of the record."""
    kind = df.schema[side].dataType if side in df.columns else None
    if not isinstance(kind, T.StructType):
        raise ValueError(f"a step on the {side} needs records whose {side} is a struct")
    change = step(df.select(f"{side}.*"))
    rest = [c for c in df.columns if c != side]
    hit = F.lit(True) if holds is None else F.coalesce(holds, F.lit(False))
    inner = df.select(F.struct(*rest, hit.alias("_hit"), F.col(side).isNotNull().alias("_there")).alias("_rest"), f"{side}.*")
    changed = apply(inner, lambda _: change, None if holds is None else F.col("_rest._hit"))
    fields = [c for c in changed.columns if c != "_rest"]
    whole = changed.select(*[F.col(f"_rest.{c}").alias(c) for c in rest], F.when(F.col("_rest._there"), F.struct(*fields)).alias(side))
    return whole.select(*df.columns)


def apply_steps(df: DataFrame, steps: Sequence[Mapping],
                predicates: Mapping[str, Column | str] | None = None) -> DataFrame:
    """Run an ordered chain as one plan.

    A step is ``{"class", "settings", "predicate", "negate"}``. A step of unknown class changes nothing and is listed
    in the column ``_placeholders`` as ``processor-<i>:<class>``, so it is never lost silently. ``$Key`` sends a step to the fields of the
    struct column ``key``, ``$Value`` to those of ``value`` where records have such a struct, and to the record itself where not.
    """
    unknown = []
    for i, item in enumerate(steps):
        holds = None
        if item.get("predicate"):
            holds = resolve_predicate(predicate_text(item["predicate"], item.get("negate", False)), predicates or {})
        name = item["class"]
        if name in _custom:
            if holds is None:
                df = _custom[name](df)
            else:
                hit = F.coalesce(holds, F.lit(False))
                df = _custom[name](df.where(hit)).unionByName(df.where(~hit), allowMissingColumns=True)
        elif step_name(name) in STEP_CLASSES:
            kind, side, settings = step_name(name), step_side(name), item.get("settings") or {}
            step = STEP_CLASSES[kind](settings, side) if kind in SIDED else STEP_CLASSES[kind](settings)
            value = side == "Value" and "value" in df.columns and isinstance(df.schema["value"].dataType, T.StructType)
            if kind in FIELD_STEPS and (side == "Key" or value):
                df = within(df, side.lower(), step, holds)
            else:
                df = apply(df, step, holds)
        else:
            unknown.append(f"processor-{i}:{name}")
    if unknown:
        df = df.withColumn("_placeholders", F.array(*[F.lit(u) for u in unknown]))
    return df
