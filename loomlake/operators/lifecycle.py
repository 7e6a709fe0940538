"""Census of snapshots, absences, health of sources, dates of ingestion, retention and refresh plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def absence_lifecycle(seen: DataFrame, runs: DataFrame, source: str, entity: str, run: str, state: DataFrame | None = None) -> DataFrame:
    """(source, entity, first_run, last_run, absences, status) for full runs numbered 1.. per source.

    ``runs``: (source, run, ordinal) of successful full runs. Absences are the runs after the last one that saw the entity; two
    or more mean NOT_SEEN. ``state``: (entity, closed, expired), of which CLOSED wins, then EXPIRED.
    """
    s = seen.join(runs, [source, run]).groupBy(source, entity).agg(F.min("ordinal").alias("first_run"), F.max("ordinal").alias("last_run"))
    last = runs.groupBy(source).agg(F.max("ordinal").alias("newest"))
    s = s.join(last, source).withColumn("absences", F.col("newest") - F.col("last_run")).drop("newest")
    if state is not None:
        s = s.join(state.select(entity, "closed", "expired"), entity, "left")
    else:
        s = s.withColumns({"closed": F.lit(False), "expired": F.lit(False)})
    status = F.when(F.coalesce("closed", F.lit(False)), "CLOSED").when(F.coalesce("expired", F.lit(False)), "EXPIRED").when(F.col("absences") >= 2, "NOT_SEEN").otherwise("ACTIVE")
    return s.withColumn("status", status).drop("closed", "expired")


def source_health(sources: DataFrame, runs: DataFrame, now: str) -> DataFrame:
    """(source_id, status): REVIEW without a run, ERROR if the latest failed, STALE over max_age seconds, else FRESH."""
    by = F.struct("created_at", "run_id")
    r = runs.groupBy("source_id").agg(F.max_by("state", by).alias("last_state"), F.max(F.when(F.col("state") == "READY", F.col("created_at"))).alias("ready_at"))
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("ready_at")
    status = F.when(F.col("ready_at").isNull(), "REVIEW").when(F.col("last_state") == "FAILED", "ERROR").when(age > F.col("max_age"), "STALE").otherwise("FRESH")
    return sources.join(r, "source_id", "left").select("source_id", status.alias("status"), age.alias("age_seconds"))


def ingestion_dates(events: DataFrame, key: str, at: str, event_id: str) -> DataFrame:
    """(key, first_day, last_day, last_id): first and latest event, civil days."""
    from ..functions.temporal import civil_day

    a = events.groupBy(key).agg(F.min(at).alias("a"), F.max(at).alias("b"), F.max_by(event_id, F.struct(at, event_id)).alias("last_id"))
    return a.select(key, civil_day(F.col("a")).alias("first_day"), civil_day(F.col("b")).alias("last_day"), "last_id")


def retention_plan(runs: DataFrame, keep_latest: int, reasons: dict, oldest: int | None = None) -> DataFrame:
    """(source_id, run_id, created_at, protections, selected): unprotected runs, the oldest N of them if given."""
    w = Window.partitionBy("source_id").orderBy(F.col("created_at").desc(), F.col("run_id").desc())
    r = runs.withColumn("_rank", F.row_number().over(w))
    marks = {f"KEEP_LATEST({keep_latest})": F.col("_rank") <= keep_latest} | reasons
    r = r.withColumn("protections", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in marks.items()])))
    r = r.withColumn("selected", F.size("protections") == 0)
    if oldest is not None:
        chosen = r.where("selected").orderBy("created_at", "run_id").limit(oldest).select("source_id", "run_id", F.lit(True).alias("_chosen"))
        r = r.join(chosen, ["source_id", "run_id"], "left").withColumn("selected", F.coalesce("_chosen", F.lit(False))).drop("_chosen")
    return r.drop("_rank")


def refresh_queue(sources: DataFrame, runs: DataFrame, failures: DataFrame, now: str) -> DataFrame:
    """Enabled sources without a run or one older than their interval, and no failure within their retry window."""
    t = F.unix_timestamp(F.lit(now).cast("timestamp"))
    last = runs.where("state = 'READY'").groupBy("source_id").agg(F.max("created_at").alias("ready_at"))
    bad = failures.groupBy("source_id").agg(F.max("failed_at").alias("failed_at"))
    s = sources.where("enabled").join(last, "source_id", "left").join(bad, "source_id", "left")
    due = F.col("ready_at").isNull() | (t - F.unix_timestamp("ready_at") > F.col("interval_seconds"))
    blocked = F.coalesce(t - F.unix_timestamp("failed_at") < F.col("retry_seconds"), F.lit(False))
    return s.where(due & ~blocked).select("source_id", F.when(F.col("ready_at").isNull(), "NEVER").otherwise("INTERVAL").alias("reason"))


def rolling_usage(events: DataFrame, key: str, at: str, value: str, seconds: int) -> DataFrame:
    """``used``: sum of a key's values in the window of so many seconds that ends with the row's time, both ends included."""
    w = Window.partitionBy(key).orderBy(F.unix_micros(F.col(at).cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    return events.withColumn("used", F.sum(value).over(w))
