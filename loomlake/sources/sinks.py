"""Writers: append-only tables, JSON-LD lines, content-addressed paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ledger import batch_conflicts, immutable_conflicts, new_rows
from ..storage import cut, discard, exists, remove


def content_path(sha256: Column) -> Column:
    return F.concat(F.lit("raw/sha256/"), F.substring(sha256, 1, 2), F.lit("/"), F.substring(sha256, 3, 2), F.lit("/"), sha256)


def content_rows(df: DataFrame, content: str) -> DataFrame:
    """(sha256, path, byte_length, copies, content): each content once; null is none."""
    d = df.where(F.col(content).isNotNull()).groupBy(F.sha2(content, 256).alias("sha256")).agg(F.first(content).alias("content"), F.count("*").alias("copies"))
    return d.select("sha256", content_path(F.col("sha256")).alias("path"), F.length("content").cast("long").alias("byte_length"), "copies", "content")


def store_additions(store: DataFrame, incoming: DataFrame, free_bytes: int | None = None) -> DataFrame:
    """What a write-once store lacks; a :class:`Conflict` where it would take more than the bytes left."""
    new = incoming.join(store.select("sha256"), "sha256", "left_anti")
    if free_bytes is not None and (new.agg(F.sum("byte_length")).first()[0] or 0) > free_bytes:
        raise Conflict("the store has no room")
    return new


def archive(rows: DataFrame, manifest: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to archive, rows to keep). The manifest's keys must all be there, once each; a key that is not is a :class:`Conflict`."""
    chosen = manifest.select(*keys)
    if not chosen.groupBy(*keys).count().where("count > 1").isEmpty() or not chosen.join(rows.select(*keys), keys, "left_anti").isEmpty():
        raise Conflict("the manifest isn't that of these rows")
    return rows.join(chosen, keys, "left_semi").select(rows.columns), rows.join(chosen, keys, "left_anti").select(rows.columns)


def move_to_archive(spark, table: str, archive_path: str, manifest: DataFrame, keys: list[str], partition: str) -> int:
    """Append the manifest's rows to the archive, check them there, then rewrite the table's partitions without them; returns their number.

    A job that dies in between can be run again: archived rows are not appended twice, and a partition is rewritten whole.
    """
    rows = spark.read.parquet(table)
    gone, kept = archive(rows, manifest, keys)
    gone, touched = cut(gone), [r[0] for r in manifest.join(rows.select(*keys, partition), keys).select(partition).distinct().collect()]
    append_new(gone, archive_path, keys)
    n = gone.count()
    if spark.read.parquet(archive_path).join(gone.select(*keys), keys, "left_semi").count() != n:
        raise Conflict("the archive lacks rows")
    stay = cut(kept.where(F.col(partition).isin(touched)))
    left = {r[0] for r in stay.select(partition).distinct().collect()}
    stay.write.partitionBy(partition).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(table)
    for value in set(touched) - left:  # partitions that nothing is left of
        remove(spark, f"{table}/{partition}={value}")
    discard(gone, stay)
    return n


class Conflict(ValueError):
    """A key has several contents."""


def append_new(df: DataFrame, path: str, keys: list[str], content: str | None = None) -> int:
    """Append rows whose key the table at ``path`` lacks and return their number.

    Two contents of one key, in the batch or beside the table, are a :class:`Conflict`, and nothing is written. A run again appends nothing.
    """
    spark = df.sparkSession
    if content and (bad := batch_conflicts(df, keys, content).limit(1).collect()):
        raise Conflict(f"several contents of {bad[0].asDict()}")
    if not exists(spark, path):
        df.dropDuplicates(keys).write.parquet(path)
        return spark.read.schema(df.schema).parquet(path).count()
    old = spark.read.schema(df.schema).parquet(path)
    if content and not immutable_conflicts(old, df, keys, content).isEmpty():
        raise Conflict("a key exists with other content")
    add = cut(new_rows(old, df, keys))
    n = add.count()
    if n:
        add.write.mode("append").parquet(path)
    discard(add)
    return n


def json_ld(nodes: DataFrame, edges: DataFrame, base: str) -> DataFrame:
    """(value): one JSON-LD object a node, its edges by predicate; write as text."""
    out = edges.groupBy("subject_id", "predicate").agg(F.array_sort(F.collect_set(F.concat(F.lit(base), "object_id"))).alias("o"))
    links = out.groupBy("subject_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("predicate", "o"))))).alias("links"))
    d = nodes.join(links, nodes["node_id"] == links["subject_id"], "left")
    head = F.to_json(F.struct(F.concat(F.lit(base), "node_id").alias("@id"), F.col("label").alias("@type")))
    body = lambda c: F.when(F.col(c).isNull() | (F.col(c) == "{}"), "").otherwise(F.concat(F.lit(","), F.expr(f"substring({c}, 2, length({c}) - 2)")))
    return d.select(F.concat(F.regexp_replace(head, r"\}$", ""), body("properties"), body("links"), F.lit("}")).alias("value"))


def sorted_list(values: DataFrame, column: str, path: str) -> None:
    """Sorted distinct values, one a line, in one file (partition lists: bounded by the catalogue)."""
    values.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct().orderBy("value").coalesce(1).write.mode("overwrite").text(path)
