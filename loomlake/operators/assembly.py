"""List and detail records as one posting, with where each field came from; conflicts; choice of names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_list_detail(records: DataFrame, keys: list[str], fields: list[str], kind: str = "representation", order: str = "record_id") -> DataFrame:
    """One row per key: detail's field unless null, else the list's; ``origin`` maps fields to their side.

    One aggregation instead of a self-join; of several records of a side the first by ``order`` counts.
    """
    first = lambda side: F.min_by(F.struct(*fields), F.when(F.col(kind) == side, F.col(order)))
    per = records.groupBy(*keys).agg(first("list").alias("_l"), first("detail").alias("_d"), F.count_if(F.col(kind) == "list").alias("n_list"), F.count_if(F.col(kind) == "detail").alias("n_detail"))
    per = per.withColumns({"_l": F.when(F.col("n_list") > 0, F.col("_l")), "_d": F.when(F.col("n_detail") > 0, F.col("_d"))})
    merged = [F.coalesce(F.col("_d")[f], F.col("_l")[f]).alias(f) for f in fields]
    origin = F.map_filter(F.create_map(*[x for f in fields for x in (F.lit(f), F.when(F.col("_d")[f].isNotNull(), "detail").when(F.col("_l")[f].isNotNull(), "list"))]), lambda k, v: v.isNotNull())
    return per.select(*keys, *merged, origin.alias("origin"), "n_list", "n_detail")


def conflict_values(records: DataFrame, key: str, value: str, kind: str = "representation") -> DataFrame:
    """(key, list_value, detail_value): every pair of differing values of a key's two sides."""
    sides = records.groupBy(key).agg(F.array_sort(F.collect_set(F.when(F.col(kind) == "list", F.col(value)))).alias("a"), F.array_sort(F.collect_set(F.when(F.col(kind) == "detail", F.col(value)))).alias("b"))
    return sides.select(key, F.explode("a").alias("list_value"), "b").select(key, "list_value", F.explode("b").alias("detail_value")).where("list_value <> detail_value")


def choose_label(candidates: DataFrame, key: str, label: str, priority: str) -> DataFrame:
    """(key, label): best priority, then most frequent, then first by bytes; aliases: the others."""
    n = candidates.where(F.col(label).isNotNull()).groupBy(key, label).agg(F.min(priority).alias("p"), F.count("*").alias("n"))
    best = n.groupBy(key).agg(F.min_by(label, F.struct("p", -F.col("n"), label)).alias("label"), F.array_sort(F.collect_set(label)).alias("_all"))
    return best.select(key, "label", F.array_remove("_all", F.col("label")).alias("aliases"))


def golden_record(facts: DataFrame, key: str, fields: list[str], orders: dict[str, list]) -> DataFrame:
    """One row per key, each field from the owner that its own order puts first (null owners' values pass)."""
    return facts.groupBy(key).agg(*[F.min_by(F.col(f), F.struct(*orders[f])).alias(f) for f in fields])


def islands(df: DataFrame, key: str, order: str, same: str) -> DataFrame:
    """``island``: number of the run of equal ``same`` values in ``order`` (gaps and islands)."""
    w = Window.partitionBy(key).orderBy(order)
    change = F.when(F.lag(same).over(w).eqNullSafe(F.col(same)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_change", change).withColumn("island", F.sum("_change").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_change")
