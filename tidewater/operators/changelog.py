"""Changelogs and table changes as DataFrame rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def retract_diff(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Changes from one keyed snapshot to the next, as -U/+U/+I/-D rows."""
    vals = [c for c in new.columns if c not in key]
    o = old.select(*key, F.struct(*vals).alias("__old"))
    n = new.select(*key, F.struct(*vals).alias("__new"))
    j = o.join(n, key, "full")
    kind = (
        F.when(F.col("__old").isNull(), F.array(F.struct(F.lit("+I").alias("op"), F.col("__new").alias("r"))))
        .when(F.col("__new").isNull(), F.array(F.struct(F.lit("-D").alias("op"), F.col("__old").alias("r"))))
        .when(
            ~F.col("__old").eqNullSafe(F.col("__new")),
            F.array(
                F.struct(F.lit("-U").alias("op"), F.col("__old").alias("r")),
                F.struct(F.lit("+U").alias("op"), F.col("__new").alias("r")),
            ),
        )
    )
    return j.select(*key, F.explode(kind).alias("c")).select("c.op", *key, "c.r.*")


def latest_per_key(df: DataFrame, key: list[str], order: list[str], is_delete: Column | None = None) -> DataFrame:
    """Last change per key wins; keys whose last change is a delete are gone.

    ``max_by`` combines before the shuffle, so a hot key sends one row per task.
    """
    rest = [c for c in df.columns if c not in key]
    src = df.withColumn("__gone", is_delete if is_delete is not None else F.lit(False))
    last = src.groupBy(*key).agg(
        F.max_by(F.struct(*rest, "__gone"), F.struct(*order)).alias("r")
    )
    return last.where(~F.col("r.__gone")).select(*key, *[F.col("r")[c].alias(c) for c in rest])


def merge(target: DataFrame, source: DataFrame, key: list[str], update: dict[str, Column], insert: dict[str, Column]) -> DataFrame:
    """MERGE: ``update`` for matched rows, ``insert`` for new keys.

    Expressions see target columns as ``t.*`` and source columns as ``s.*``.
    Several source rows for one target row are an error.
    """
    source_columns = source.columns
    # Counted where the join wants the rows anyway, so the source is read and shuffled once.
    source = source.withColumn("__copies", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    t, s = target.alias("t"), source.alias("s")
    cond = None
    for k in key:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    j = t.withColumn("__in_t", F.lit(True)).alias("t").join(
        s.withColumn("__in_s", F.lit(True)).alias("s"), cond, "full")
    matched = F.col("t.__in_t").isNotNull() & F.col("s.__in_s").isNotNull()
    fresh = F.col("t.__in_t").isNull()
    twice = matched & (F.col("s.__copies") > 1)
    error = F.raise_error(F.lit("MERGE: several source rows match one target row"))
    out = []
    for c in target.columns:
        keep = F.col(f"t.{c}")
        new = insert.get(c, F.col(f"s.{c}") if c in source_columns else F.lit(None))
        out.append(F.when(fresh, new).when(twice, error.cast(target.schema[c].dataType)).when(matched, update.get(c, keep)).otherwise(keep).alias(c))
    return j.select(*out)


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """DELETE: rows whose condition is false or unknown stay."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def update_where(df: DataFrame, cond: Column, sets: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(cond, F.lit(False))
    return df.select(
        *[F.when(hit, sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c) for c in df.columns]
    )
