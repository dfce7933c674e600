"""Write operators: what a table holds after rows are inserted, filled in or merged.

Sources are reduced to one row per key first, so the joins with the target are one to
one and no key can grow hot in them.
"""

from __future__ import annotations

from collections.abc import Sequence
from enum import Enum, auto
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtflow.operators.keyed import absent_from, carried, one_per_key
from courtflow.schemas import TableSpec


class WriteAction(Enum):
    INSERT = auto()
    UPDATE = auto()
    UPSERT = auto()


def drop_null_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.dropna(how="any", subset=list(spec.primary_key))


def with_reject_reason(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add ``reject_reason``: the first broken rule among the columns present.

    A null where it is forbidden counts only for columns the rows bring along, and a
    null never breaks a ``>= 0`` rule.
    """
    reason = F.lit(None).cast("string")
    rules: list[tuple[Column, str]] = []
    for c in spec.primary_key:
        rules.append((F.col(c).isNull(), f"{c} is null in key"))
    for c in spec.not_null:
        missing = F.col(c).isNull() if c in df.columns else F.lit(True)
        rules.append((missing, f"{c} is null"))
    for c in spec.non_negative:
        if c in df.columns:
            rules.append((F.coalesce(F.col(c) < 0, F.lit(False)), f"{c} is negative"))
    for broken, text in reversed(rules):
        reason = F.when(broken, F.lit(text)).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def constraint_check(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the table's rules, and the others with the reason."""
    checked = with_reject_reason(df, spec)
    valid = checked.filter("reject_reason IS NULL").drop("reject_reason")
    return valid, checked.filter("reject_reason IS NOT NULL")


def _source(
    df: DataFrame, spec: TableSpec, order: Sequence[Column] | None
) -> DataFrame:
    return one_per_key(drop_null_keys(df, spec), spec.primary_key, order)


def _fit(df: DataFrame, target: DataFrame) -> DataFrame:
    """The target's columns in order, null where the rows have none."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.schema.fields
        ]
    )


def rows_to_insert(
    target: DataFrame,
    df: DataFrame,
    spec: TableSpec,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Rows whose key the target lacks, one per key. Only target keys are read."""
    new = absent_from(_source(df, spec, order), target, spec.primary_key, few=True)
    return _fit(new, target)


def insert_ignore(
    target: DataFrame,
    df: DataFrame,
    spec: TableSpec,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The target with those rows added; existing rows stay as they are."""
    return target.unionByName(rows_to_insert(target, df, spec, order))


def _prefixed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(
        *keys, *[F.col(c).alias(f"new_{c}") for c in df.columns if c not in keys],
        F.lit(True).alias("_given"),
    )


def with_fill_update(
    target: DataFrame,
    df: DataFrame,
    spec: TableSpec,
    guard: str | None = None,
    columns: Sequence[str] | None = None,
    null_overwrites: bool = True,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """``fill_update`` with a flag ``_written`` on the rows it sets."""
    keys = list(spec.primary_key)
    present = [c for c in df.columns if c not in (*keys, *carried(df))]
    set_columns = [c for c in present if columns is None or c in columns]
    if not set_columns:
        return target.withColumn("_written", F.lit(False))
    guard = guard or set_columns[0]
    source = _source(df.select(*keys, *set_columns, *carried(df)), spec, order)
    written = F.coalesce("_given", F.lit(False)) & F.col(guard).isNull()

    def value(c: str) -> Column:
        if c not in set_columns:
            return F.col(c)
        new = F.col(f"new_{c}").cast(target.schema[c].dataType)
        new = new if null_overwrites else F.coalesce(new, F.col(c))
        return F.when(written, new).otherwise(F.col(c)).alias(c)

    return target.join(_prefixed(source, keys), keys, "left").select(
        *[value(c) for c in target.columns], written.alias("_written")
    )


def fill_update(
    target: DataFrame,
    df: DataFrame,
    spec: TableSpec,
    guard: str | None = None,
    columns: Sequence[str] | None = None,
    null_overwrites: bool = True,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The target with all given columns set where the guard column is still null.

    The guard is the first non-key column of the rows unless named. Rows without
    non-key columns change nothing. ``null_overwrites=False`` keeps a stored value
    where the row has none, as for fields its document lacked.
    """
    return with_fill_update(
        target, df, spec, guard, columns, null_overwrites, order
    ).drop("_written")


def with_upsert(
    target: DataFrame,
    df: DataFrame,
    spec: TableSpec,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """``upsert`` with a flag ``_written`` on the rows it sets or adds.

    Two joins rather than a full one, which would shuffle the target for any batch.
    """
    keys = list(spec.primary_key)
    source = _source(df, spec, order)
    given = F.coalesce("_given", F.lit(False))

    def value(c: str) -> Column:
        if c in keys or c not in df.columns:
            return F.col(c)
        # a given null overwrites too
        new = F.col(f"new_{c}").cast(target.schema[c].dataType)
        return F.when(given, new).otherwise(F.col(c)).alias(c)

    kept = target.join(_prefixed(source, keys), keys, "left").select(
        *[value(c) for c in target.columns], given.alias("_written")
    )
    added = rows_to_insert(target, df, spec, order).withColumn("_written", F.lit(True))
    return kept.unionByName(added)


def upsert(
    target: DataFrame,
    df: DataFrame,
    spec: TableSpec,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The target with rows added, or all their non-key columns overwritten."""
    return with_upsert(target, df, spec, order).drop("_written")


def union_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames for one table and action, matched by column name."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), frames
    )
