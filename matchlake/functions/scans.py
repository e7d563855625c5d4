"""Ordered scans per key that stay bounded when one key owns a large share of the rows.

A window partitioned by key puts each key into one task. For ordinary keys that is the right plan.
Rows of *hot* keys are range-partitioned on (key, order) instead, so one key is cut into many
slices; the scan runs per slice and each slice receives what the earlier slices of the same key
pass on. Only a key that crosses a slice border passes anything on, and a slice has two borders,
so the carried table has at most two rows per slice, whatever the data size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.session import reliable_checkpoint, written

SLICE = "__slice"
HOT_KEY_ROWS = 2_000_000


@dataclass(frozen=True)
class Running:
    """One running value over the rows strictly before the current one.

    kind: 'last' (last non-NULL), 'sum' or 'max'.
    """

    name: str
    kind: str
    value: Column


def split_hot(df: DataFrame, key: str, limit: int = HOT_KEY_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys and rows of keys with more than ``limit`` rows (None when there are none).

    The count is a map-side-combined aggregation; at most rows/limit keys can qualify.
    """
    hot = df.groupBy(key).count().where(F.col("count") > limit).select(F.col(key).alias("__hot"))
    if hot.isEmpty():
        return df, None
    hot = written(hot, "hot-keys")
    match = F.col(key).eqNullSafe(F.col("__hot"))
    return df.join(hot, match, "left_anti"), df.join(hot, match, "left_semi")


def slice_rows(df: DataFrame, key: str, order: list[str], slices: int) -> DataFrame:
    """Range-partition on (key, order) and remember the partition as the slice number.

    Written to the checkpoint folder, because two reads of the plan could sample other borders.
    """
    ranged = df.repartitionByRange(slices, key, *order)
    return reliable_checkpoint(ranged.withColumn(SLICE, F.spark_partition_id()))


def _local(keys: list[str], order: list[str], sliced: bool):
    spec = Window.partitionBy(*([SLICE] if sliced else []), *keys).orderBy(*order)
    return spec.rowsBetween(Window.unboundedPreceding, -1)


def _over(item: Running, window) -> Column:
    if item.kind == "last":
        return F.last(item.value, ignorenulls=True).over(window)
    if item.kind == "sum":
        return F.coalesce(F.sum(item.value).over(window), F.lit(0).cast("bigint"))
    if item.kind == "max":
        return F.max(item.value).over(window)
    raise ValueError(item.kind)


def _merge(item: Running, carried: Column, local: Column) -> Column:
    if item.kind == "last":
        return F.coalesce(local, carried)
    if item.kind == "sum":
        return local + F.coalesce(carried, F.lit(0).cast("bigint"))
    return F.greatest(local, carried)


def running_before(df: DataFrame, keys: list[str], order: list[str], items: list[Running]) -> DataFrame:
    """Add each running value. ``df`` is sliced if it carries the slice column."""
    sliced = SLICE in df.columns
    window = _local(keys, order, sliced)
    result = df.select("*", *[_over(i, window).alias(i.name) for i in items])
    if not sliced:
        return result
    ordering = F.struct(*[F.col(c) for c in order])
    totals = []
    for item in items:
        if item.kind == "last":
            totals.append(F.max_by(item.value, F.when(item.value.isNotNull(), ordering)).alias(item.name))
        elif item.kind == "sum":
            totals.append(F.sum(item.value).alias(item.name))
        else:
            totals.append(F.max(item.value).alias(item.name))
    per_slice = df.groupBy(*keys, SLICE).agg(*totals)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slice.select(
        *[F.col(k).alias(f"__k{n}") for n, k in enumerate(keys)],
        F.col(SLICE).alias("__s"),
        F.count(F.lit(1)).over(earlier).alias("__n"),
        *[_over(Running(i.name, i.kind, F.col(i.name)), earlier).alias(f"__c_{i.name}") for i in items],
    ).where(F.col("__n") > 0)
    on = F.col(SLICE) == F.col("__s")
    for n, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{n}"))
    joined = result.join(carry, on, "left")
    merged = joined.select(
        *df.columns,
        *[_merge(i, F.col(f"__c_{i.name}"), F.col(i.name)).alias(i.name) for i in items],
    )
    return reliable_checkpoint(merged)


def next_in_key(df: DataFrame, key: str, order: list[str], values: dict[str, str]) -> DataFrame:
    """Add, under new names, the given columns of the row that follows within the key."""
    sliced = SLICE in df.columns
    spec = Window.partitionBy(*([SLICE] if sliced else []), key).orderBy(*order)
    following = F.lead(F.struct(*[F.col(c).alias(n) for n, c in values.items()])).over(spec)
    result = df.select("*", following.alias("__next"))
    if sliced:
        ordering = F.struct(*[F.col(c) for c in order])
        heads = df.groupBy(key, SLICE).agg(
            F.min_by(F.struct(*[F.col(c).alias(n) for n, c in values.items()]), ordering).alias("head")
        )
        later = heads.select(
            F.col(key).alias("__k"),
            F.col(SLICE).alias("__s"),
            F.lead("head").over(Window.partitionBy(key).orderBy(SLICE)).alias("__carried"),
        ).where(F.col("__carried").isNotNull())
        on = (F.col(SLICE) == F.col("__s")) & F.col(key).eqNullSafe(F.col("__k"))
        result = result.join(later, on, "left").withColumn("__next", F.coalesce("__next", "__carried"))
    return result.select(*df.columns, *[F.col(f"__next.{n}").alias(n) for n in values])
