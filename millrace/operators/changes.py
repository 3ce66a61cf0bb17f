"""A record step expressed as columns to set, columns to drop and rows to keep.

Every built-in step is one projection. That lets a predicate wrap any of them column by column, in the same pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Change:
    put: dict[str, Column] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    keep: Column | None = None


Step = Callable[[DataFrame], Change]


def apply(df: DataFrame, step: Step, holds: Column | None = None) -> DataFrame:
    """Run ``step`` on all rows, or only on rows where ``holds`` is true (null counts as false).

    Under a predicate a dropped column stays, empty on the rows the step touched, because other rows need it.
    """
    change = step(df)
    if holds is None:
        out = df.where(change.keep) if change.keep is not None else df
        if not change.put and not change.drop:
            return out
        kept = [F.col(_quoted(c)) for c in df.columns if c not in change.drop and c not in change.put]
        order = [c for c in df.columns if c in change.put] + [c for c in change.put if c not in df.columns]
        return out.select(*kept, *[change.put[c].alias(c) for c in order])

    hit = F.coalesce(holds, F.lit(False))
    out = df.where(~hit | change.keep) if change.keep is not None else df
    columns = []
    for name in df.columns:
        old = F.col(_quoted(name))
        if name in change.put:
            columns.append(F.when(hit, change.put[name]).otherwise(old).alias(name))
        elif name in change.drop:
            columns.append(F.when(~hit, old).alias(name))
        else:
            columns.append(old)
    columns += [F.when(hit, new).alias(name) for name, new in change.put.items() if name not in df.columns]
    return out.select(*columns)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
