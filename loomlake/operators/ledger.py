"""Ledger operators: latest rows, cut-offs, differences, append-only writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the row that is largest by ``order``; one aggregation with partial sums, no sort of a key's rows.

    End ``order`` with an id, so that ties have one result.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in rest])


def as_of(df: DataFrame, keys: list[str], order: list[str], cutoff_column: str, cutoff: Column | int) -> DataFrame:
    """Latest per key among rows up to a cut-off."""
    return latest_by(df.where(F.col(cutoff_column) <= (F.lit(cutoff) if isinstance(cutoff, int) else cutoff)), keys, order)


def latest_ready_run(runs: DataFrame) -> DataFrame:
    """Newest READY run per source that is not a smoke run."""
    return latest_by(runs.where("state = 'READY' AND mode <> 'SMOKE'"), ["source_id"], ["created_at", "run_id"])


def as_of_join(left: DataFrame, right: DataFrame, key: str, at: str, right_at: str, right_id: str, slice_seconds: int = 86_400) -> DataFrame:
    """Each left row with the last right row of its key up to its time, nulls where there is none; of right rows at one time the one of the greatest ``right_id``.

    Time is cut into slices: rows are sorted within a key and slice, and what was last before a slice is carried over from one row for each key and slice. So a hot
    key is many tasks, and no pairs are made.
    """
    rest = [c for c in right.columns if c != key]
    part = lambda c: F.floor(F.unix_timestamp(c) / slice_seconds)
    b = right.select(key, F.lit(0).alias("_side"), F.col(right_at).alias("_at"), F.struct(*rest).alias("_r"), F.col(right_id).alias("_rid")).withColumn("_slice", part("_at"))
    a = left.withColumns({"_side": F.lit(1), "_at": F.col(at), "_slice": part(at)})
    both = a.unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(key, "_slice").orderBy("_at", "_side", "_rid").rowsBetween(Window.unboundedPreceding, 0)
    own = both.withColumn("_r", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    ends = both.groupBy(key, "_slice").agg(F.max_by("_r", F.when(F.col("_side") == 0, F.struct("_at", "_rid"))).alias("_end"))
    before = ends.withColumn("_last", F.last("_end", ignorenulls=True).over(Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select(F.col(key).alias("_k"), F.col("_slice").alias("_s"), "_last")
    j = own.join(before, F.col(key).eqNullSafe(F.col("_k")) & F.col("_slice").eqNullSafe(F.col("_s")), "left").withColumn("_r", F.coalesce("_r", "_last"))
    return j.select(*left.columns, *[F.col("_r")[c].alias(f"asof_{c}") for c in rest])


def symmetric_difference(expected: DataFrame, actual: DataFrame, bag: bool = False) -> DataFrame:
    """Rows of one side only, with ``side``; as sets, or with multiplicity."""
    minus = (lambda a, b: a.exceptAll(b)) if bag else (lambda a, b: a.subtract(b))
    actual = actual.select(*expected.columns)
    return minus(expected, actual).withColumn("side", F.lit("MISSING")).unionByName(minus(actual, expected).withColumn("side", F.lit("UNEXPECTED")))


def new_rows(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """What an append-only writer has to add; repeated incoming keys once."""
    return incoming.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def immutable_conflicts(existing: DataFrame, incoming: DataFrame, keys: list[str], content: str) -> DataFrame:
    """Incoming rows whose key exists with other content."""
    old = existing.select(*keys, F.col(content).alias("existing_content"))
    return incoming.join(old, keys).where(~F.col(content).eqNullSafe(F.col("existing_content")))


def batch_conflicts(incoming: DataFrame, keys: list[str], content: str) -> DataFrame:
    """Keys that one batch brings with several contents, null being one."""
    return incoming.groupBy(*keys).agg(F.count_distinct(F.struct(content)).alias("contents")).where("contents > 1")


def upsert_latest(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Both sides' rows, the newest of each key: an older run never overrides a newer one."""
    return latest_by(existing.unionByName(incoming), keys, order)
