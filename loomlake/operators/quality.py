"""Completeness, issue bags, quarantine and pair consistency."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_completeness(
    pages: DataFrame, keys: list[str], page: str = "page_no", size: str = "page_size", total: str = "declared_total", items: str = "item_count", ordinal: str | None = None, identities: str | None = None, detail: str | None = None
) -> DataFrame:
    """(keys, pages, expected, reason): the first rule that a partition's pages break, null for a complete one.

    ``identities`` (array) must not repeat in a partition; a ``detail`` partition (boolean) is one page of one row; total and size are the same on all pages; a
    total of 0 takes two confirmed empty answers of page 1 (``ordinal`` 0 and 1); else pages 1..ceil(total / size), once each, each answered once (``ordinal`` 0) and as full as
    the total tells.
    """
    p, s, n, i = F.col(page), F.col(size), F.col(total), F.col(items)
    turn = F.col(ordinal) if ordinal else None
    full = F.least(s, n - (p - 1) * s)
    a = pages.groupBy(*keys).agg(
        F.count("*").alias("pages"), F.count_distinct(p).alias("_distinct"), F.min(p).alias("_low"), F.max(p).alias("_high"), F.min(n).alias("_total"), F.max(n).alias("_total_high"), F.min(s).alias("_size"), F.max(s).alias("_size_high"),
        F.sum(i).alias("_rows"), F.bool_and((i == full) & (turn == 0 if ordinal else F.lit(True))).alias("_full"), F.bool_and((p == 1) & (i == 0)).alias("_empty"), (F.array_sort(F.collect_list(turn)) if ordinal else F.array(F.lit(0), F.lit(1))).alias("_turns"),
        (F.bool_or(F.col(detail)) if detail else F.lit(False)).alias("_detail"),
    )
    repeated = F.lit(False)
    if identities:
        ids = pages.select(*keys, F.explode(identities).alias("_id")).groupBy(*keys, "_id").agg(F.count("*").alias("_n")).where("_n > 1").select(*keys).distinct().withColumn("_repeated", F.lit(True))
        a, repeated = a.join(ids, keys, "left"), F.coalesce("_repeated", F.lit(False))
    expected = F.when(F.col("_total") == 0, 2).otherwise(F.ceil(F.col("_total") / F.col("_size"))).cast("long")
    turns = F.transform("_turns", lambda x: x.cast("int"))
    reason = (
        F.when(repeated, "DUPLICATE_IDENTITY")
        .when(F.col("_detail") & ((F.col("pages") != 1) | (F.col("_rows") != 1)), "DETAIL_COUNT")
        .when(F.col("_detail"), F.lit(None))
        .when((F.col("_total") != F.col("_total_high")) | (F.col("_size") != F.col("_size_high")), "UNSTABLE_PAGINATION")
        .when((F.col("_total") == 0) & ((F.col("pages") != 2) | ~F.col("_empty") | (turns != F.array(F.lit(0), F.lit(1)))), "EMPTY_NOT_CONFIRMED")
        .when(F.col("_total") == 0, F.lit(None))
        .when((F.col("pages") != expected) | (F.col("_distinct") != F.col("pages")) | (F.col("_low") != 1) | (F.col("_high") != expected), "PAGES_MISSING_OR_REPEATED")
        .when(~F.col("_full"), "PAGE_ROW_COUNT")
    )
    return a.select(*keys, "pages", expected.alias("expected"), reason.alias("reason"))


def list_detail_mismatch(listed: DataFrame, detailed: DataFrame, identity: str) -> DataFrame:
    """(identity, side): identities that only the lists or only the details of a run have."""
    a = listed.select(identity).distinct().withColumn("_list", F.lit(True))
    b = detailed.select(identity).distinct().withColumn("_detail", F.lit(True))
    return a.join(b, identity, "full").where("_list IS NULL OR _detail IS NULL").select(identity, F.when(F.col("_list").isNull(), "DETAIL_ONLY").otherwise("LIST_ONLY").alias("side"))


def contiguous(df: DataFrame, key: str, number: str) -> DataFrame:
    """(key, n, complete): numbers 1..n, each once."""
    a = df.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(number).alias("d"), F.min(number).alias("low"), F.max(number).alias("high"))
    return a.select(key, "n", ((F.col("d") == F.col("n")) & (F.col("low") == 1) & (F.col("high") == F.col("n"))).alias("complete"))


def issue_bag(rules: dict[str, DataFrame]) -> DataFrame:
    """(issue, location): rows of each rule's ``location``, all branches together."""
    return reduce(DataFrame.unionByName, [d.select(F.lit(name).alias("issue"), F.col("location").cast("string").alias("location")) for name, d in rules.items()])


def with_reasons(df: DataFrame, reasons: dict[str, Column], name: str = "reasons") -> DataFrame:
    """Sorted names of the conditions that hold; unknown counts as not holding."""
    return df.withColumn(name, F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in reasons.items()]))))


def quarantine(df: DataFrame, reasons: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with error_code: the first reason)."""
    code = F.coalesce(*[F.when(c, F.lit(n)) for n, c in reasons.items()])
    d = df.withColumn("error_code", code)
    return d.where("error_code IS NULL").drop("error_code"), d.where("error_code IS NOT NULL")


def pair_consistency(left: DataFrame, right: DataFrame, key: str, facts: list[str]) -> DataFrame:
    """(key, issue): keys of one side only, and facts that differ null-safely."""
    a = left.select(key, F.struct(*facts).alias("_a"))
    b = right.select(key, F.struct(*facts).alias("_b"))
    differ = F.array_compact(F.array(*[F.when(~F.col("_a")[f].eqNullSafe(F.col("_b")[f]), F.lit(f"DIFFERS_{f.upper()}")) for f in facts]))
    issue = F.when(F.col("_b").isNull(), F.array(F.lit("ONLY_LIST"))).when(F.col("_a").isNull(), F.array(F.lit("ONLY_DETAIL"))).otherwise(differ)
    return a.join(b, key, "full").select(key, F.explode(issue).alias("issue"))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, rows, nulls, distinct_values) of each column, in one pass."""
    stats = [F.struct(F.lit(c).alias("field"), F.count("*").alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count_distinct(c).alias("distinct_values")).alias(c) for c in columns]
    return df.agg(*stats).select(F.inline(F.array(*columns)))
