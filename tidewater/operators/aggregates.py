"""Aggregates composed from built-in ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum0(x: Column) -> Column:
    return F.coalesce(F.sum(x), F.lit(0))


def single_value(x: Column) -> Column:
    """The group's one value; more than one row is an error."""
    return F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit("SINGLE_VALUE: more than one row"))
    ).otherwise(F.any_value(x))


def group_id_union(df: DataFrame, cols: list[str], sets: list[list[str]], aggs: list[Column]) -> DataFrame:
    """GROUPING SETS with ``group_id``: the ordinal among equal grouping sets.

    Each distinct set is aggregated once (all of them in one pass); a set
    that is listed n times only copies its result rows n times.
    """
    wanted: dict[tuple[str, ...], int] = {}
    for s in sets:
        k = tuple(c for c in cols if c in s)
        wanted[k] = wanted.get(k, 0) + 1
    once = df.groupingSets([[F.col(c) for c in k] for k in wanted], *[F.col(c) for c in cols]) \
        .agg(F.grouping_id().alias("__gid"), *aggs)
    bit = lambda k: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in k)
    copies = reduce(
        lambda acc, kv: acc.when(F.col("__gid") == bit(kv[0]), kv[1]), wanted.items(), F.when(F.lit(False), 0)
    )
    return once.withColumn("group_id", F.explode(F.sequence(F.lit(0), copies - 1))).drop("__gid")


def collect_bag(df: DataFrame, by: list[str], value: str, alias: str = "bag") -> DataFrame:
    """COLLECT as (value, multiplicity) pairs.

    Equal values are counted before the shuffle, so the collected group is as
    long as its distinct values, not its rows.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    pair = F.struct(F.col(value).alias("value"), F.col("n"))
    return counted.groupBy(*by).agg(F.array_sort(F.collect_list(pair)).alias(alias))


def fuse_bags(df: DataFrame, by: list[str], bag: str, alias: str = "bag") -> DataFrame:
    """FUSION: bag union of counted bags; counts are added before collecting."""
    pairs = df.select(*by, F.explode(bag).alias("p"))
    counted = pairs.groupBy(*by, F.col("p.value").alias("value")).agg(F.sum("p.n").alias("n"))
    pair = F.struct("value", "n")
    return counted.groupBy(*by).agg(F.array_sort(F.collect_list(pair)).alias(alias))


def bag_to_array(bag: Column) -> Column:
    """Plain array of a counted bag."""
    return F.flatten(F.transform(bag, lambda p: F.array_repeat(p.value, p.n.cast("int"))))


def json_objectagg(key: Column, value: Column, absent_on_null: bool = False) -> Column:
    """Rows to one JSON object; for groups whose keys are few."""
    pair = F.struct(key.alias("k"), value.alias("v"))
    pair = F.when(value.isNotNull(), pair) if absent_on_null else pair
    return F.to_json(
        F.map_from_entries(F.array_sort(F.collect_list(pair))), {"ignoreNullFields": "false"}
    )


def json_arrayagg(value: Column, absent_on_null: bool = True) -> Column:
    """Rows to one sorted JSON array; for groups of few values."""
    if absent_on_null:
        return F.to_json(F.array_sort(F.collect_list(value)))
    wrapped = F.transform(F.array_sort(F.collect_list(F.struct(value.alias("v")))), lambda s: s.v)
    return F.to_json(wrapped, {"ignoreNullFields": "false"})


def skew_report(df: DataFrame, key: Column, max_groups: int, tasks: int) -> DataFrame:
    """Rows per task if ``key`` were spread over ``tasks`` by key group."""
    group = F.pmod(key, F.lit(max_groups))
    per_task = df.groupBy(F.floor(group * tasks / max_groups).cast("int").alias("task")) \
        .agg(F.count(F.lit(1)).alias("n"))
    total = per_task.agg(F.struct(F.max("n").alias("top"), F.avg("n").alias("mean")).alias("s")).scalar()
    return per_task.withColumn("skew", total.getField("top") / total.getField("mean"))


def hash_range_bucket(lo: Column, hi: Column, bound: float, n: int) -> Column:
    """Bucket of the middle of a hash range ``[lo, hi]`` in ``[0, bound)``."""
    mid = (lo.cast("double") + hi.cast("double")) / 2
    return F.floor(mid / F.lit(float(bound)) * n).cast("int")
