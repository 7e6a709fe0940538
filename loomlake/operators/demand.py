"""Demand counts, feeds and pages, crosswalk proposals."""

from __future__ import annotations

import base64
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def demand(links: DataFrame, code: str, posting: str, evidence: list[str], evidence_order: list[str], samples: int = 3) -> DataFrame:
    """(code, postings, links, evidence): distinct postings, links, and the first few evidence rows of each code.

    Evidence is cut to ``samples`` a code by a ranked window, of which Spark keeps that many rows a partition before the shuffle.
    """
    from pyspark.sql import Window

    counts = links.groupBy(code).agg(F.count_distinct(posting).alias("postings"), F.count("*").alias("links"))
    rank = F.row_number().over(Window.partitionBy(code).orderBy(*evidence_order))
    few = links.withColumn("_r", rank).where(F.col("_r") <= samples).groupBy(code).agg(F.array_sort(F.collect_list(F.struct("_r", *evidence))).alias("evidence"))
    return counts.join(few, code)


def page(df: DataFrame, order: list[Column], size: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(size)


def keyset_page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """Rows after a key, one more than the page holds, so that the reader knows of a next page."""
    d = df if after is None else df.where(F.col(key) > F.lit(after))
    return d.orderBy(key).limit(size + 1)


def cursor(scope: str, last: str) -> str:
    return base64.urlsafe_b64encode(json.dumps({"scope": scope, "last": last}, sort_keys=True).encode()).decode()


def read_cursor(text: str, scope: str) -> str:
    """The last key of a cursor; of another scope it is refused."""
    got = json.loads(base64.urlsafe_b64decode(text.encode()))
    if got.get("scope") != scope:
        raise ValueError("the cursor belongs to another query")
    return got["last"]


def feed(postings: DataFrame, q: str | None = None, region: str | None = None, text: str = "title", region_column: str = "region", open_filter: Column | None = None) -> DataFrame:
    """Optional filters: only given ones enter the plan, so they reach the scan."""
    d = postings
    if q:
        d = d.where(F.contains(F.lower(text), F.lit(q.lower())))
    if region:
        d = d.where(F.col(region_column) == region)
    return d if open_filter is None else d.where(open_filter)


def exam_feed(sessions: DataFrame, dates: list[str], start, end) -> DataFrame:
    """``first_date``: earliest of a session's dates; kept if any date lies within [start, end]."""
    every = F.array_compact(F.array(*dates))
    d = sessions.withColumn("first_date", F.array_min(every))
    return d.where(F.exists(every, lambda x: x.between(F.lit(start), F.lit(end))))


def co_occurrence(links: DataFrame, key: str, kind: str, code: str, left: str, right: str, least: int = 1) -> DataFrame:
    """(left_code, right_code, shared): codes of two kinds on the same key; each key's codes are made distinct before they meet."""
    a = links.where(F.col(kind) == left).select(key, F.col(code).alias("left_code")).distinct()
    b = links.where(F.col(kind) == right).select(key, F.col(code).alias("right_code")).distinct()
    return a.join(b, key).groupBy("left_code", "right_code").agg(F.count("*").alias("shared")).where(F.col("shared") >= least)


def freshness(stored: Column, current: Column) -> Column:
    return F.when(stored.isNull(), "UNKNOWN").when(stored == current, "CURRENT").otherwise("STALE")
