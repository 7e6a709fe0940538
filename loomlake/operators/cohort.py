"""Cohorts over a window with explicit reasons of exclusion; review ledgers and their status ladders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ledger import as_of


def cohort(postings: DataFrame, reasons: dict[str, Column], group: str, order: list[Column], entity: str) -> DataFrame:
    """``reasons`` sorted, and ``outcome``: INCLUDED for a group's best eligible member, DUPLICATE for its others, else EXCLUDED.

    ``order``: ascending columns, ending with an id.
    """
    from .quality import with_reasons

    p = with_reasons(postings, reasons)
    eligible = F.size("reasons") == 0
    best = p.where(eligible).groupBy(group).agg(F.min_by(entity, F.struct(*order)).alias("_best"))
    p = p.join(best, group, "left")
    outcome = F.when(~eligible, "EXCLUDED").when(F.col(entity) == F.col("_best"), "INCLUDED").otherwise("DUPLICATE")
    p = p.withColumn("outcome", outcome)
    return p.withColumn("reasons", F.when(F.col("outcome") == "DUPLICATE", F.array(F.lit("DUPLICATE_NON_REPRESENTATIVE"))).otherwise(F.col("reasons"))).drop("_best")


def ladder(*steps: tuple[str, Column], default: str) -> Column:
    """The first name whose condition holds; unknown conditions do not."""
    out = None
    for name, condition in steps:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return out.otherwise(default)


def review_status(proposals: DataFrame, decisions: DataFrame, key: str, proposal_cutoff: int, decision_cutoff: int) -> DataFrame:
    """(key, proposal_id, status) at a cut-off: latest proposal, and its latest decision by another than its proposer.

    Every latest proposal has a row; a decision of the proposer's own counts as none.
    """
    p = as_of(proposals, [key], ["proposal_no"], "proposal_no", proposal_cutoff)
    own = decisions.join(proposals.select("proposal_id", "proposer").distinct(), "proposal_id", "left").where("proposer IS NULL OR reviewer <> proposer")
    d = as_of(own.select(decisions.columns), ["proposal_id"], ["decision_id"], "decision_id", decision_cutoff).select("proposal_id", "decision")
    status = ladder(("REJECTED", F.col("decision") == "REJECT"), ("ACCEPTED", F.col("decision") == "ACCEPT"), default="PENDING")
    return p.join(d, "proposal_id", "left").select(key, "proposal_id", status.alias("status"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """(value, n) of an array column's members: the reasons of an exclusion report."""
    return df.select(F.explode(column).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def tracks(cohort_: DataFrame, track_rows: DataFrame, reasons: Column) -> DataFrame:
    """Cohort members (entity, outcome, reasons) with ``tracks``: sorted profiles of their eligible tracks (entity, profile, ...); one that none qualifies for is EXCLUDED by NO_QUALIFYING_TRACK and its tracks' reasons."""
    t = track_rows.withColumn("_r", reasons)
    a = t.groupBy("entity").agg(F.array_sort(F.collect_set(F.when(F.size("_r") == 0, F.col("profile")))).alias("tracks"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_r")))).alias("_why"))
    j = cohort_.join(a, "entity", "left").withColumns({"tracks": F.coalesce("tracks", F.array().cast("array<string>")), "_why": F.coalesce("_why", F.array().cast("array<string>"))})
    none = (F.col("outcome") == "INCLUDED") & (F.size("tracks") == 0)
    why = F.array_sort(F.array_distinct(F.concat("reasons", F.col("_why"), F.array(F.lit("NO_QUALIFYING_TRACK")))))
    return j.withColumns({"reasons": F.when(none, why).otherwise(F.col("reasons")), "outcome": F.when(none, "EXCLUDED").otherwise(F.col("outcome"))}).drop("_why")


def manifest(cohort_: DataFrame) -> DataFrame:
    """(outcome, members, hash): counts and set hashes of the members with their reasons, by which a cohort is sealed and checked."""
    from ..functions.hashing import set_hash

    m = cohort_.select("outcome", F.concat_ws("\n", F.col("entity").cast("string"), F.array_join("reasons", ",")).alias("m"))
    return set_hash(m, ["outcome"], "m").select("outcome", F.col("members").cast("long").alias("members"), F.col("set_hash").alias("hash"))


def claim_support(cohort_: DataFrame, claims: DataFrame) -> DataFrame:
    """(entity, claims, supported) of the included members for claims (entity, claim, evidence: number of spans)."""
    n = claims.groupBy("entity").agg(F.count("*").alias("claims"), F.count_if(F.col("evidence") > 0).alias("supported"))
    return cohort_.where("outcome = 'INCLUDED'").select("entity").join(n, "entity", "left").select("entity", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("claims", "supported")])


def serving_state(cohort_: DataFrame, postings: DataFrame, at: str, fresh_seconds: int) -> DataFrame:
    """Members (entity, outcome) with ``state`` at a time, for postings (entity, closed, last_day, last_seen_at).

    CLOSED, EXPIRED (its last day is over), STALE (not seen for ``fresh_seconds``), ACTIVE; members that aren't included or have no posting are NOT_SERVED.
    """
    now = F.lit(at).cast("timestamp")
    j = cohort_.join(postings, "entity", "left")
    state = ladder(
        ("NOT_SERVED", (F.col("outcome") != "INCLUDED") | F.col("last_seen_at").isNull()), ("CLOSED", F.col("closed")), ("EXPIRED", F.col("last_day") < F.to_date(now)), ("STALE", F.unix_timestamp(now) - F.unix_timestamp("last_seen_at") > fresh_seconds), default="ACTIVE"
    )
    return j.select("entity", "outcome", state.alias("state"))
