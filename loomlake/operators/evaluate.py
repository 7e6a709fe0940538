"""Stratified samples and scores against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold_space
from ..storage import cut


def stratified_sample(df: DataFrame, stratum: str, row_id: str, seed: str, size: int) -> DataFrame:
    """The first ``size`` rows of each stratum by a hash of seed and id, with their ``place``; the same rows at every run."""
    h = F.sha2(F.concat(F.lit(seed + ":"), F.col(row_id).cast("string")), 256)
    place = F.row_number().over(Window.partitionBy(stratum).orderBy(h, row_id))
    return df.withColumn("place", place.cast("long")).where(F.col("place") <= size)


def precision_recall(df: DataFrame, predicted: Column, actual: Column, by: list[str] = ()) -> DataFrame:
    """Counts and ratios; a ratio without a denominator is null; rows with an unknown side are abstentions."""
    p, a = predicted, actual
    d = df.groupBy(*by).agg(
        F.count("*").alias("rows"), F.count_if(p & a).alias("true_positive"), F.count_if(p & ~a).alias("false_positive"), F.count_if(~p & a).alias("false_negative"), F.count_if(p.isNull() | a.isNull()).alias("abstained")
    )
    precision = F.try_divide("true_positive", F.col("true_positive") + F.col("false_positive"))
    recall = F.try_divide("true_positive", F.col("true_positive") + F.col("false_negative"))
    return d.withColumns({"precision": F.round(precision, 6), "recall": F.round(recall, 6)})


def exact_duplicates(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """(row_id, group_id, representative, members) of texts that are equal when folded: lower case, white space as one space; nulls are one group."""
    d = cut(df.select(row_id, F.unhex(F.sha2(F.lower(fold_space(F.col(text))), 256)).alias("_h")))  # texts are read once
    g = cut(d.groupBy("_h").agg(F.min(row_id).alias("representative"), F.count("*").alias("members")))
    return d.join(g.withColumnRenamed("_h", "_g"), F.col("_h").eqNullSafe(F.col("_g"))).select(row_id, F.lower(F.hex("_h")).alias("group_id"), "representative", "members")


def retrieval_recall(gold: DataFrame, shortlist: DataFrame, key: list[str], cutoffs: list[int]) -> DataFrame:
    """(cutoff, labels, found, recall): labelled pairs that a shortlist (key, rank) has within each rank."""
    j = gold.join(shortlist.select(*key, "rank"), key, "left")
    counts = [F.struct(F.lit(c).alias("cutoff"), F.count("*").alias("labels"), F.count_if(F.col("rank") <= c).alias("found")).alias(f"c{c}") for c in cutoffs]
    d = j.agg(*counts).select(F.inline(F.array(*[f"c{c}" for c in cutoffs])))
    return d.withColumn("recall", F.round(F.try_divide("found", "labels"), 6))


def label_matches(gold: DataFrame, predicted: DataFrame, key: list[str], label: str) -> DataFrame:
    """(label, matched, missed, added): each label of a row counted once, on both sides."""
    a = gold.select(*key, label).distinct().withColumn("_g", F.lit(True))
    b = predicted.select(*key, label).distinct().withColumn("_p", F.lit(True))
    j = a.join(b, [*key, label], "full")
    return j.groupBy(label).agg(F.count_if(F.col("_g") & F.col("_p")).alias("matched"), F.count_if(F.col("_p").isNull()).alias("missed"), F.count_if(F.col("_g").isNull()).alias("added"))
