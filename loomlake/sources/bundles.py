"""Bundles of local files: a manifest of paths, digests and lengths, a hash of the whole, and the check of files against it; catalogue rows joined to a bundle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import set_hash


def manifest(files: DataFrame, root: str) -> DataFrame:
    """(name, sha256, byte_length) of raw files under a folder, names relative to it; a file outside keeps its path."""
    start = root.rstrip("/") + "/"
    at = F.instr("path", start)
    return files.select(F.when(at > 0, F.expr(f"substring(path, instr(path, '{start}') + {len(start)})")).otherwise(F.col("path")).alias("name"), "sha256", "byte_length")


def bundle_hash(manifest_: DataFrame) -> str | None:
    """Of the set of names, digests and lengths; null for an empty bundle."""
    row = set_hash(manifest_.select(F.lit(1).alias("k"), F.concat_ws("\n", "name", "sha256", "byte_length").alias("m")), ["k"], "m").first()
    return row["set_hash"] if row else None


def bundle_issues(files: DataFrame, manifest_: DataFrame) -> DataFrame:
    """(name, issue) of files (name, sha256, byte_length) against a manifest: REPEATED_NAME, MISSING, UNEXPECTED, CHANGED."""
    twice = manifest_.groupBy("name").count().where("count > 1").select("name", F.lit("REPEATED_NAME").alias("issue"))
    a, b = (d.select("name", F.struct("sha256", "byte_length").alias(c)) for d, c in ((files, "_a"), (manifest_, "_b")))
    j = a.join(b, "name", "full")
    issue = F.when(F.col("_a").isNull(), "MISSING").when(F.col("_b").isNull(), "UNEXPECTED").when(F.col("_a") != F.col("_b"), "CHANGED")
    return twice.unionByName(j.select("name", issue.alias("issue")).where("issue IS NOT NULL"))


def catalogue(occupations: DataFrame, taxonomy: DataFrame, elements: DataFrame, ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries (code, title, major, elements, rated), issues (issue, location)) of a catalogue read from tab-separated files.

    ``occupations``: (code, title); ``taxonomy``: (code, parent); ``elements``: (element_id, name); ``ratings``: (code, element_id, scale, value, suppress). Suppressed and unknown values aren't counted as rated.
    """
    known = occupations.select("code").distinct()
    r = ratings.groupBy("code").agg(F.count_distinct("element_id").alias("elements"), F.count_if(F.col("value").isNotNull() & ~F.coalesce("suppress", F.lit(False))).alias("rated"))
    entries = occupations.join(r, "code", "left").select("code", "title", F.substring("code", 1, 2).alias("major"), F.coalesce("elements", F.lit(0)).alias("elements"), F.coalesce("rated", F.lit(0)).alias("rated"))
    bag = lambda name, d, at: d.select(F.lit(name).alias("issue"), at.alias("location"))
    issues = [
        bag("REPEATED_CODE", occupations.groupBy("code").count().where("count > 1"), F.col("code")),
        bag("TITLE_MISSING", occupations.where(F.coalesce(F.trim("title"), F.lit("")) == ""), F.col("code")),
        bag("PARENT_MISSING", taxonomy.where("parent IS NOT NULL").join(taxonomy.select(F.col("code").alias("parent")), "parent", "left_anti"), F.col("code")),
        bag("RATED_CODE_MISSING", ratings.select("code").distinct().join(known, "code", "left_anti"), F.col("code")),
        bag("ELEMENT_MISSING", ratings.select("element_id").distinct().join(elements.select("element_id"), "element_id", "left_anti"), F.col("element_id")),
    ]
    return entries, reduce(DataFrame.unionByName, issues)
