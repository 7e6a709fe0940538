"""Readers of raw snapshots: CSV in UTF-8 or CP949, JSON envelopes, NDJSON, verified bytes, expected partitions."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, byte_length, content); Spark lists no empty files."""
    d = spark.read.format("binaryFile").load(path)
    return d.select("path", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("byte_length"), "content")


def verified(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose digest and length are those of the manifest (sha256, byte_length)."""
    return files.join(manifest.select("sha256", "byte_length").distinct(), ["sha256", "byte_length"], "left_semi")


def csv_records(files: DataFrame, header: list[str]) -> DataFrame:
    """(path, locator, fields..., error_code) from whole files: UTF-8 (with or without a mark), else CP949; strict width.

    Spark's CSV source knows neither CP949 nor record numbers, so bytes are decoded in Python, a file at a time.
    """
    names = ["path", "locator", *header, "error_code"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def rows(path: str, content: bytes) -> Iterator[tuple]:
        try:
            text = content.decode("utf-8-sig")
        except UnicodeDecodeError:
            try:
                text = content.decode("cp949")
            except UnicodeDecodeError:
                yield (path, "file", *[None] * len(header), "ENCODING")
                return
        reader = csv.reader(io.StringIO(text, newline=""), strict=True)
        try:
            first = next(reader, None)
            if first != header:
                yield (path, "csv:header", *[None] * len(header), "HEADER")
                return
            for n, row in enumerate(reader, 1):
                yield (path, f"csv:record:{n}", *row, None) if len(row) == len(header) else (path, f"csv:record:{n}", *[None] * len(header), "WIDTH")
        except csv.Error:
            yield (path, "csv", *[None] * len(header), "SYNTAX")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                buffer: list[tuple] = []
                for row in rows(path, content):
                    buffer.append(row)
                    if len(buffer) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*buffer, strict=True)], names)
                        buffer = []
                if buffer:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*buffer, strict=True)], names)

    return files.select("path", "content").mapInArrow(run, schema)


def json_envelope(df: DataFrame, body: str, item: T.StructType, total: str = "totalCount") -> DataFrame:
    """(columns of df without body, n, item, declared_total, error_code) of the three shapes {root|body: {items}}, {result}."""
    shape = T.StructType([T.StructField(k, T.StructType([T.StructField("items", T.ArrayType(item)), T.StructField(total, T.StringType())])) for k in ("root", "body")] + [T.StructField("result", T.ArrayType(item)), T.StructField(total, T.StringType())])
    p = df.withColumn("_j", F.from_json(body, shape))
    items = F.coalesce("_j.root.items", "_j.body.items", "_j.result")
    declared = F.coalesce(f"_j.root.{total}", f"_j.body.{total}", f"_j.{total}").cast("long")
    p = p.withColumns({"_items": items, "declared_total": declared, "error_code": F.when(items.isNull(), "ENVELOPE")})
    return p.select(*[c for c in df.columns if c != body], "declared_total", "error_code", F.posexplode_outer("_items").alias("n", "item"))


def json_rows(df: DataFrame, body: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): objects only; invalid JSON and repeated keys are rejected."""
    v = F.try_parse_json(F.col(body))
    error = F.when(F.trim(F.coalesce(body, F.lit(""))) == "", "BLANK").when(v.isNull(), "INVALID_JSON").when(~F.trim(body).startswith("{"), "NOT_AN_OBJECT")
    d = df.withColumn("error_code", error)
    return d.where("error_code IS NULL").drop("error_code"), d.where("error_code IS NOT NULL")


def expected_partitions(codes: DataFrame, code: str, first_year: int, last_year: int) -> DataFrame:
    """(code, year, partition_id) of every code and year."""
    d = codes.select(code).distinct().withColumn("year", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))))
    return d.withColumn("partition_id", F.concat(F.lit("year-"), F.col("year"), F.lit("-item-"), F.col(code)))


def body_issue(content: Column, extension: Column, most: int = 50_000_000) -> Column:
    """EMPTY, TOO_LARGE, or MAGIC where the first bytes are not those of the extension."""
    start = F.hex(F.substring(content, 1, 8))
    magic = F.when(F.lower(extension) == "pdf", start.startswith("25504446")).when(F.lower(extension).isin("hwpx", "zip", "docx", "xlsx"), start.startswith("504B0304")).when(F.lower(extension) == "hwp", start.startswith("D0CF11E0"))
    return F.when(F.length(content) == 0, "EMPTY").when(F.length(content) > most, "TOO_LARGE").when(~magic, "MAGIC")


def envelope_issue(requested_page: Column, requested_size: Column, page: Column, size: Column, total: Column, items: Column) -> Column:
    """What an envelope's page metadata says against its request: TOTAL_MISSING, PAGE_MISMATCH, SIZE_MISMATCH, TOO_MANY_ITEMS, ITEMS_WITHOUT_TOTAL; null where it fits.

    A source that tells no page or size has nulls there, which fit.
    """
    left = F.greatest(F.lit(0), total - (requested_page - 1) * requested_size)
    return (
        F.when(total.isNull() | (total < 0), "TOTAL_MISSING").when(page != requested_page, "PAGE_MISMATCH").when(size != requested_size, "SIZE_MISMATCH").when((total == 0) & (items > 0), "ITEMS_WITHOUT_TOTAL")
        .when(items > F.least(requested_size, left), "TOO_MANY_ITEMS")
    )
