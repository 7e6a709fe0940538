"""Resumable NDJSON ingestion: batches with byte and line checkpoints, a hash chain and a seal; streaming state.

A file comes as batches (run_id, start_byte, start_line, text, sha256), each of whole lines. A batch is taken if it begins where the
last one ended; the same batch again is a replay and changes nothing; another text at the same place is a conflict. Each batch adds a
link to the run's hash chain, and a run is sealed when its batches cover the file's bytes and their bytes have the file's digest.

Defined results: a batch of wrong digest, of no or too many bytes or lines, or without a final newline is refused as a whole, and so is one with a line
that is blank, begins with a byte order mark, is no JSON object or repeats a key; the first such line is named ``line:<n>@byte:<n>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_chain
from ..operators.ledger import latest_by
from ..sources.readers import json_rows
from ..storage import cut, discard, exists

MAX_BYTES, MAX_LINES, MAX_LINE_BYTES = 32 * 2**20, 5000, 16 * 2**20
CHAIN_START = "ndjson-chunks-v1"


def batch_lines(batches: DataFrame) -> DataFrame:
    """(run_id, start_byte, line_number, byte_offset, byte_length, raw_sha256, body, issue) of every line, its newline counted."""
    parts = F.split("text", "\n")
    whole = F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: F.concat(x, F.lit("\n")))
    d = batches.select("run_id", "start_byte", "start_line", F.posexplode(whole).alias("n", "raw"))
    before = Window.partitionBy("run_id", "start_byte").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    body = F.regexp_replace(F.expr("left(raw, length(raw) - 1)"), r"\r\z", "")
    row = F.try_parse_json("body")
    # a repeated key makes the text invalid for the parser, and a plain one doesn't
    issue = (
        F.when(F.octet_length("raw") > MAX_LINE_BYTES, "LINE_TOO_LARGE")
        .when(F.trim(F.replace("body", F.lit("\t"), F.lit(" "))) == "", "BLANK_LINE")
        .when(F.col("body").startswith("﻿"), "BYTE_ORDER_MARK")
        .when(row.isNull() & F.get_json_object("body", "$").startswith("{"), "REPEATED_KEY")
        .when(row.isNull() | ~F.schema_of_variant(row).startswith("OBJECT"), "INVALID_JSON")
    )
    d = d.select("run_id", "start_byte", (F.col("start_line") + F.col("n")).alias("line_number"), (F.col("start_byte") + F.coalesce(F.sum(F.octet_length("raw")).over(before), F.lit(0))).alias("byte_offset"), F.octet_length("raw").cast("long").alias("byte_length"), F.sha2("raw", 256).alias("raw_sha256"), body.alias("body"), "raw")
    return d.withColumn("issue", issue).drop("raw")


def batch_issues(batches: DataFrame, lines_: DataFrame) -> DataFrame:
    """(run_id, start_byte, issue, location): why a batch is refused, null where it isn't."""
    size = F.octet_length("text")
    whole = (
        F.when(F.col("text").isNull() | (size < 1) | (size > MAX_BYTES) | ~F.sha2("text", 256).eqNullSafe(F.col("sha256")), "HASH_OR_SIZE")
        .when(~F.col("text").endswith("\n"), "FINAL_NEWLINE_REQUIRED")
        .when(F.size(F.split("text", "\n")) - 1 > MAX_LINES, "TOO_MANY_LINES")
    )
    bad = lines_.where("issue IS NOT NULL").groupBy("run_id", "start_byte").agg(F.min_by(F.struct("issue", "line_number", "byte_offset"), "line_number").alias("b"))
    at = lambda line, byte: F.concat(F.lit("line:"), line, F.lit("@byte:"), byte)
    d = batches.select("run_id", "start_byte", "start_line", whole.alias("whole")).join(bad, ["run_id", "start_byte"], "left")
    return d.select("run_id", "start_byte", F.coalesce("whole", "b.issue").alias("issue"), F.when(F.col("whole").isNotNull(), at(F.col("start_line"), F.col("start_byte"))).when(F.col("b").isNotNull(), at(F.col("b.line_number"), F.col("b.byte_offset"))).alias("location"))


def chunks_of(batches: DataFrame, lines_: DataFrame) -> DataFrame:
    """(run_id, start_byte, start_line, byte_length, line_count, sha256, line_manifest) of accepted batches."""
    manifest = lines_.groupBy("run_id", "start_byte").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_number", "byte_offset", "byte_length", "raw_sha256"))), lambda x: F.concat_ws(":", x["line_number"], x["byte_offset"], x["byte_length"], x["raw_sha256"])), "\n"), 256).alias("line_manifest"), F.count("*").alias("line_count"))
    return batches.select("run_id", "start_byte", "start_line", F.octet_length("text").cast("long").alias("byte_length"), "sha256").join(manifest, ["run_id", "start_byte"])


def checked(chunks: DataFrame) -> DataFrame:
    """Chunks with ``issue`` CHECKPOINT where one doesn't begin at the byte and line at which the one before it ended."""
    w = Window.partitionBy("run_id").orderBy("start_byte")
    end = F.lag(F.struct((F.col("start_byte") + F.col("byte_length")).alias("b"), (F.col("start_line") + F.col("line_count")).alias("l"))).over(w)
    fits = (F.col("start_byte") == F.coalesce(end["b"], F.lit(0))) & (F.col("start_line") == F.coalesce(end["l"], F.lit(1)))
    return chunks.withColumn("issue", F.when(~fits, "CHECKPOINT"))


def chained(chunks: DataFrame) -> DataFrame:
    """Chunks with the run's hash chain."""
    step = F.concat_ws(":", "start_byte", "start_line", "byte_length", "line_count", "sha256", "line_manifest")
    return hash_chain(chunks.withColumn("step", step), "run_id", "start_byte", "step", CHAIN_START).drop("step")


def replays(done: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming chunks with ``outcome``: NEW, REPLAYED (the same again) or REPLAY_CONFLICT (another at the same place)."""
    old = done.select("run_id", "start_byte", F.struct("start_line", "byte_length", "sha256").alias("_old"))
    own = F.struct("start_line", "byte_length", "sha256")
    return incoming.join(old, ["run_id", "start_byte"], "left").withColumn("outcome", F.when(F.col("_old").isNull(), "NEW").when(F.col("_old") == own, "REPLAYED").otherwise("REPLAY_CONFLICT")).drop("_old")


def append(spark: SparkSession, path: str, batches: DataFrame) -> DataFrame:
    """Take batches into the tables under ``path`` and return (run_id, start_byte, outcome, location), outcome being an issue where a batch is refused.

    Lines are written before chunks, and only lines of a written chunk count, so a job that dies between the two leaves no half batch.
    """
    kept = cut(batches.select("run_id", "start_byte", "start_line", "text", "sha256"))
    every = cut(batch_lines(kept))
    issues = batch_issues(kept, every)
    new = chunks_of(kept.join(issues.where("issue IS NULL").select("run_id", "start_byte"), ["run_id", "start_byte"]), every)
    table = f"{path}/chunks"
    done = spark.read.schema(new.schema).parquet(table) if exists(spark, table) else spark.createDataFrame([], new.schema)
    judged = cut(replays(done, new))
    fresh = judged.where("outcome = 'NEW'").drop("outcome")
    runs = done.join(fresh.select("run_id").distinct(), "run_id", "left_semi")
    broken = cut(checked(runs.unionByName(fresh)).where("issue IS NOT NULL").groupBy("run_id").agg(F.min("start_byte").alias("from_byte")))
    fresh = cut(fresh.join(broken, "run_id", "left").withColumn("ok", F.col("from_byte").isNull() | (F.col("start_byte") < F.col("from_byte"))).drop("from_byte"))
    good = fresh.where("ok").drop("ok")
    every.join(good.select("run_id", "start_byte"), ["run_id", "start_byte"], "left_semi").drop("issue").write.mode("append").parquet(f"{path}/lines")
    good.select(new.columns).write.mode("append").parquet(table)
    key = ["run_id", "start_byte"]
    outcome = judged.select(*key, "outcome").join(fresh.select(*key, "ok"), key, "left")
    out = issues.join(outcome, key, "left").select(*key, F.coalesce("issue", F.when(F.col("ok") == F.lit(False), "CHECKPOINT"), "outcome").alias("outcome"), "location")
    out = cut(out)
    discard(kept, every, judged, broken, fresh)
    return out


def sealed(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """(run_id, state, lines, chain): READY where the chunks of a file (run_id, byte_length) cover it without a gap, else the issue."""
    c = checked(chunks)
    ends = c.groupBy("run_id").agg(F.max(F.col("start_byte") + F.col("byte_length")).alias("_end"), F.sum("line_count").alias("lines"), F.bool_or(F.col("issue").isNotNull()).alias("_gap"))
    last = chained(chunks).groupBy("run_id").agg(F.max_by("chain", "start_byte").alias("chain"))
    state = F.when(F.col("_end").isNull() | F.col("_gap") | (F.col("_end") != F.col("byte_length")), "CHECKPOINT_INCOMPLETE").otherwise("READY")
    return files.join(ends, "run_id", "left").join(last, "run_id", "left").select("run_id", state.alias("state"), F.coalesce("lines", F.lit(0)).cast("long").alias("lines"), F.when(state == "READY", F.col("chain")).alias("chain"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, source_path) of text files as they arrive."""
    return spark.readStream.format("text").load(path).select("value", F.col("_metadata.file_path").alias("source_path"))


def ingest(spark: SparkSession, path: str, accepted: str, rejected: str, checkpoint: str):
    """Append rows of new files to two Parquet tables and stop when all are read.

    The checkpoint has the files that are done; each batch writes to its own folder ``batch=<id>`` and overwrites it, so a
    batch that is repeated after a failure leaves the same rows once.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        good, bad = json_rows(batch.withColumn("row_hash", F.sha2("value", 256)), "value")
        good.write.mode("overwrite").parquet(f"{accepted}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")

    q = lines(spark, path).writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def latest_state(spark: SparkSession, stream: DataFrame, path: str, keys: list[str], order: list[str], checkpoint: str, buckets: int = 64):
    """Keep the newest row per key of a stream in Parquet: delta rows update, omitted keys stay as they are, older rows never win.

    The state lies in ``bucket=<hash of the keys>``; a batch rewrites the buckets that it touches. The newest row of old and new is the same when
    a batch is repeated, so a repeat after a failure is harmless.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        own = batch.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = [r[0] for r in own.select("bucket").distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        if exists(batch.sparkSession, path):
            own = batch.sparkSession.read.schema(own.schema).parquet(path).where(F.col("bucket").isin(touched)).unionByName(own)
        merged = cut(latest_by(own, [*keys, "bucket"], order))
        merged.write.partitionBy("bucket").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
        discard(merged)

    q = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def windowed_counts(stream: DataFrame, at: str, key: str, window: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Counts per key and window with a watermark: late rows up to ``late`` still count."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window), key).agg(F.count("*").alias("n"))


def source_watermark(rows: DataFrame, source: str, at: str) -> DataFrame:
    """(source, watermark): up to when a snapshot has seen its source."""
    return rows.groupBy(source).agg(F.max(at).alias("watermark"))


def due(state: DataFrame, now: Column) -> DataFrame:
    """Sources whose tick has come: ``attempts`` failures in a row double the wait from ``interval_seconds``, up to ``most_seconds``."""
    wait = F.least(F.col("interval_seconds") * F.pow(F.lit(2), F.least("attempts", F.lit(30))), F.col("most_seconds"))
    return state.withColumn("wait_seconds", wait.cast("long")).where(F.col("last_at").isNull() | (F.unix_timestamp(now) - F.unix_timestamp("last_at") >= F.col("wait_seconds")))
