"""Content hashes: of rows, of sets, of chains."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def text_hash(value: Column) -> Column:
    return F.sha2(value.cast("string"), 256)


def namespaced_hash(namespace: str, value: Column) -> Column:
    return F.sha2(F.concat(F.lit(namespace + ":"), value), 256)


def row_hash(*columns: str, namespace: str = "row-v1") -> Column:
    """Of the columns' canonical JSON: keys in byte order, nulls kept."""
    return namespaced_hash(namespace, F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}))


def set_hash(df: DataFrame, keys: list[str], member: str, buckets: int = 64) -> DataFrame:
    """(keys, members, set_hash): independent of order and partitions, without a list of all members in one row.

    Members are dealt to buckets by their hash; a bucket is hashed over its sorted distinct members, the set over its buckets'
    hashes in order.
    """
    d = df.select(*keys, F.col(member).cast("string").alias("m")).where("m IS NOT NULL").distinct()
    d = d.withColumn("bucket", F.pmod(F.xxhash64("m"), F.lit(buckets)))
    per = d.groupBy(*keys, "bucket").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("m")), "\n"), 256).alias("h"), F.count("*").alias("n"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "h"))), lambda x: F.concat(x["bucket"].cast("string"), F.lit(":"), x["h"])), "\n")
    return per.groupBy(*keys).agg(F.sum("n").alias("members"), F.sha2(joined, 256).alias("set_hash"))


def plain_set_hash(member: Column) -> Column:
    """Aggregate for small groups: sha256 of the sorted members, one a line."""
    return F.sha2(F.array_join(F.array_sort(F.collect_set(member.cast("string"))), "\n"), 256)


def hash_chain(df: DataFrame, key: str, order: str, value: str, start: str = "") -> DataFrame:
    """``chain``: sha256 over the last link and the row (a file's chunks, in their order).

    A chain is sequential by nature: rows are dealt by key and sorted, and each partition is folded as it streams by, so a key
    takes time in proportion to its rows and no memory. Nulls count as empty.
    """
    schema = StructType([*df.schema.fields, StructField("chain", StringType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, link, begun = None, start, False
        for batch in batches:
            links = []
            for k, v in zip(batch.column("_chain_key").to_pylist(), batch.column("_chain_value").to_pylist(), strict=True):
                if not begun or k != at:
                    at, link, begun = k, start, True
                link = hashlib.sha256(f"{link}|{v or ''}".encode()).hexdigest()
                links.append(link)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), pa.array(links, pa.string())], names)

    d = df.withColumns({"_chain_key": F.col(key).cast("string"), "_chain_value": F.col(value).cast("string")})
    return d.repartition(key).sortWithinPartitions("_chain_key", order).mapInArrow(run, schema)
