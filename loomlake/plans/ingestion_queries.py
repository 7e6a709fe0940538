"""Normalizers, NDJSON batches, paged sources, inputs and stores over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import normalize
from ..sources import paged, sinks
from ..streaming import ndjson
from .registry import query, t


def js(**columns):
    """JSON text of columns; nulls are left out."""
    return F.to_json(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]))


# --- normalizers ---


@query("""WITH r AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y%m%d') AS a, strftime(o_orderdate + INTERVAL ((o_orderkey % 11) - 2) DAY, '%Y%m%d') AS b, o_orderkey % 7 AS m FROM orders)
SELECT k, CASE WHEN m = 1 AND k % 2 = 1 THEN 'PARTITION_IDENTITY_MISMATCH' WHEN m = 2 THEN 'INVALID_ONGOING_STATUS' WHEN m = 3 THEN 'INVALID_DATE' WHEN b < a THEN 'INVALID_POSTING_DATE_RANGE' WHEN m = 4 THEN 'MISSING_REQUIRED_FIELD' WHEN m = 5 THEN 'INVALID_NONNEGATIVE_INTEGER' END AS error_code,
CASE WHEN error_code IS NULL THEN k || ':' || CASE WHEN k % 2 = 1 THEN 'detail' ELSE 'list' END END AS source_record_id, CASE WHEN error_code IS NULL THEN 'Title ' || k END AS title, CASE WHEN error_code IS NULL AND m = 0 THEN true END AS ongoing,
CASE WHEN error_code IS NULL THEN strptime(b, '%Y%m%d')::DATE::VARCHAR END AS closing, CASE WHEN error_code IS NULL THEN k % 9 END AS headcount FROM r""")
def normalized_postings(spark, sf_dir):
    m, k = F.col("o_orderkey") % 7, F.col("o_orderkey")
    body = js(
        recrutPblntSn="o_orderkey", recrutPbancTtl=F.when(m != 4, F.concat(F.lit("  Title "), k, F.lit("\u00a0"))).otherwise(" "), pblntInstCd=F.lit("C1"), instNm=F.lit("Office"),
        pbancBgngYmd=F.date_format("o_orderdate", "yyyyMMdd"), pbancEndYmd=F.when(m == 3, "20260230").otherwise(F.date_format(F.date_add(F.to_date("o_orderdate"), ((k % 11) - 2).cast("int")), "yyyyMMdd")),
        ongoingYn=F.when(m == 0, "Y").when(m == 2, "maybe").otherwise(""), recrutNope=F.when(m == 5, "-1").otherwise((k % 9).cast("string")),
    )
    part = F.when((m == 1) & (k % 2 == 1), "detail-0").when(k % 2 == 1, F.concat(F.lit("detail-"), k)).otherwise("list")
    d = normalize.normalize(t(spark, sf_dir, "orders").select(k.alias("k"), body.alias("body"), part.alias("p")), "body", "posting", "p")
    return d.select("k", "error_code", "source_record_id", "normalized.title", "normalized.ongoing", F.col("normalized.closing_date").cast("string").alias("closing"), "normalized.headcount")


@query("""WITH r AS (SELECT p_partkey AS k, p_partkey % 6 AS m, lpad(p_partkey::VARCHAR, 10, '0') || '_21v' || (p_partkey % 3) AS code FROM part)
SELECT k, CASE m WHEN 1 THEN 'INVALID_CODE' WHEN 2 THEN 'INVALID_NONNEGATIVE_INTEGER' WHEN 3 THEN 'MISSING_REQUIRED_FIELD' WHEN 4 THEN 'ROW_NOT_OBJECT' END AS error_code, CASE WHEN m IN (0, 5) THEN code END AS source_record_id, CASE WHEN m IN (0, 5) THEN nullif(k % 4, 0) END AS level,
CASE WHEN m IN (0, 5) AND k % 4 = 0 THEN 'UNSPECIFIED_LEVEL' WHEN m IN (0, 5) THEN '' END AS flags, CASE WHEN m IN (0, 5) THEN code[:8] END AS occupation_code FROM r""")
def normalized_competencies(spark, sf_dir):
    m, k = F.col("p_partkey") % 6, F.col("p_partkey")
    code = F.concat(F.lpad(k.cast("string"), 10, "0"), F.lit("_21v"), k % 3)
    body = js(ncsClCd=F.when(m == 1, "12").otherwise(code), compeUnitName=F.when(m != 3, F.col("p_name")), compeUnitLevel=F.when(m == 2, "x").otherwise((k % 4).cast("string")), ncsSubdCdnm=F.lit("Group"))
    d = normalize.normalize(t(spark, sf_dir, "part").select(k.alias("k"), F.when(m == 4, F.concat(F.lit("["), body, F.lit("]"))).otherwise(body).alias("body")), "body", "competency")
    return d.select("k", "error_code", "source_record_id", "normalized.level", F.array_join("flags", ",").alias("flags"), "normalized.occupation_code")


@query("""WITH r AS (SELECT o_orderkey AS k, o_orderkey % 5 AS m, strftime(o_orderdate, '%Y') AS y, o_orderdate::DATE AS a, (o_orderdate + INTERVAL ((o_orderkey % 4) - 1) DAY)::DATE AS b FROM orders)
SELECT k, CASE WHEN m = 1 THEN 'PARTITION_IDENTITY_MISMATCH' WHEN m = 2 THEN 'PARTITION_IDENTITY_MISMATCH' WHEN m = 3 THEN 'INVALID_DATE' WHEN b < a THEN 'REVERSED_DATE_RANGE' END AS error_code,
CASE WHEN error_code IS NULL THEN 'A00' || (k % 10) || ':' || y || ':T:' || (k % 4 + 1) END AS source_record_id, CASE WHEN error_code IS NULL THEN b::VARCHAR END AS closes FROM r""")
def normalized_exam_sessions(spark, sf_dir):
    m, k = F.col("o_orderkey") % 5, F.col("o_orderkey")
    item, year = F.concat(F.lit("A00"), k % 10), F.date_format("o_orderdate", "yyyy")
    body = js(implYy=F.when(m == 1, "1900").otherwise(year), jmCd=F.when(m == 2, "B999").when(k % 3 == 0, item), implSeq=(k % 4 + 1).cast("string"), qualgbCd=F.lit("T"), description=F.lit("Exam"), docRegStartDt=F.date_format("o_orderdate", "yyyyMMdd"), docRegEndDt=F.date_format(F.date_add(F.to_date("o_orderdate"), ((k % 4) - 1).cast("int")), "yyyyMMdd"), pracPassDt=F.when(m == 3, "2026023"))
    d = normalize.normalize(t(spark, sf_dir, "orders").select(k.alias("k"), body.alias("body"), F.concat(F.lit("year-"), year, F.lit("-item-"), item).alias("p")), "body", "exam_session", "p")
    return d.select("k", "error_code", "source_record_id", F.col("normalized.docRegEndDt").cast("string").alias("closes"))


_URL = r"(?i)^https?://(?:www\.)?jobs\.example\.com/view/([0-9]+)(?:[/?#].*)?$"


@query("""WITH r AS (SELECT o_orderkey AS k, o_orderkey % 12 AS m, o_orderdate::DATE AS a, (o_orderdate + INTERVAL ((o_orderkey % 13) - 1) DAY)::DATE AS b FROM orders)
SELECT k, CASE WHEN m = 1 THEN NULL ELSE k::VARCHAR END AS posting_id, CASE WHEN m = 2 THEN 'UNKNOWN' WHEN m = 3 THEN 'CATEGORY_ONLY' ELSE 'NAME_UNVERIFIED' END AS employer_identity_kind, CASE WHEN m = 4 THEN 'CLOSED' ELSE 'UNKNOWN' END AS source_status,
CASE WHEN m = 4 THEN 'UNKNOWN' WHEN m IN (5, 7) THEN 'ROLLING' WHEN m = 6 THEN 'UNTIL_FILLED' WHEN m = 8 THEN 'UNKNOWN' WHEN m = 9 THEN 'FIXED_INSTANT' ELSE 'FIXED_DATE' END AS deadline_kind,
CASE WHEN m = 4 THEN 'SOURCE_STATUS' WHEN m = 5 THEN 'USER_POLICY' WHEN m = 8 THEN 'INVALID_SOURCE_FIELD' ELSE 'SOURCE_FIELD' END AS deadline_basis, CASE WHEN m NOT IN (4, 5, 6, 7, 8, 9) THEN b::VARCHAR END AS deadline_date,
concat_ws(',', CASE WHEN m = 1 THEN 'INVALID_POSTING_REFERENCE:product_page_url' END, CASE WHEN m = 10 THEN 'MISSING_OR_INVALID_TITLE:job_title' END, CASE WHEN m = 8 THEN 'INVALID_DATE:application_end_date' END, CASE WHEN m NOT IN (4, 5, 6, 7, 8, 9) AND b < a THEN 'END_BEFORE_START:application_end_date' END, CASE WHEN m = 11 THEN 'INVALID_RECRUITMENT_COUNT:recruitment_count' END, CASE WHEN m = 9 THEN 'INVALID_TEXT_TYPE:salary' END) AS errors,
concat_ws(',', CASE WHEN m = 3 THEN 'EMPLOYER_CATEGORY_ONLY' END, CASE WHEN m = 2 THEN 'EMPLOYER_UNKNOWN' END, CASE WHEN m = 5 THEN 'DEADLINE_ASSUMED_ROLLING' END, CASE WHEN k % 5 = 0 THEN 'ROLE_IS_APPLICATION_METHOD' END, CASE WHEN k % 2 = 0 THEN 'DESCRIPTION_MISSING' END) AS flags FROM r""")
def normalized_listings(spark, sf_dir):
    m, k = F.col("o_orderkey") % 12, F.col("o_orderkey")
    day, last = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format(F.date_add(F.to_date("o_orderdate"), ((k % 13) - 1).cast("int")), "yyyy-MM-dd")
    end = F.when(m.isin(4, 5), None).when(m == 6, "채용시까지").when(m == 7, "상시").when(m == 8, "soon").when(m == 9, F.concat(last, F.lit("T10:00:00+09:00"))).otherwise(F.concat(last, F.lit("T00:00:00Z")))
    body = js(
        product_page_url=F.when(m == 1, "ftp://x").otherwise(F.concat(F.lit("https://jobs.example.com/view/"), k, F.lit("?x=1"))), job_title=F.when(m != 10, "Title"), company_name=F.when(m == 2, " 비공개 ").when(m == 3, "중소기업 (제조)").otherwise("Acme"),
        is_closed=F.when(m == 4, True), application_start_date=day, application_end_date=end, job_position=F.when(k % 5 == 0, "온라인 지원").otherwise("Clerk"), description_text=F.when(k % 2 == 1, "text").otherwise("  "), recruitment_count=F.when(m == 11, 2.5).otherwise(F.lit(None).cast("double")),
        salary=F.when(m == 9, F.array(F.lit(1))),
    )
    d = normalize.normalize_listings(t(spark, sf_dir, "orders").select(k.alias("k"), body.alias("body")), "body", _URL)
    said = F.array_join(F.transform("errors", lambda e: F.concat_ws(":", e["code"], e["field"])), ",")
    return d.select("k", "posting_id", "employer_identity_kind", "source_status", "deadline_kind", "deadline_basis", F.col("deadline_date").cast("string").alias("deadline_date"), said.alias("errors"), F.array_join("flags", ",").alias("flags"))


# --- NDJSON batches ---

_BATCH_SQL = """l AS (SELECT c_nationkey AS run_id, c_custkey, '{"id":' || c_custkey || ',"name":"é' || c_name || '"}' || chr(10) AS raw, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i FROM customer),
b AS (SELECT run_id, i // 20 AS chunk, string_agg(raw, '' ORDER BY i) AS body, min(i) + 1 AS start_line, count(*) AS line_count FROM l GROUP BY ALL),
o AS (SELECT *, coalesce(sum(octet_length(encode(body))) OVER (PARTITION BY run_id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_byte FROM b)"""


def _batches(spark, sf_dir):
    from pyspark.sql import Window

    c = t(spark, sf_dir, "customer", F.col("c_nationkey").cast("string").alias("run_id"), "c_custkey", F.concat(F.lit('{"id":'), "c_custkey", F.lit(',"name":"é'), "c_name", F.lit('"}\n')).alias("raw"))
    c = c.withColumn("i", F.row_number().over(Window.partitionBy("run_id").orderBy("c_custkey")) - 1).withColumn("chunk", F.floor(F.col("i") / 20))
    b = c.groupBy("run_id", "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "raw"))), lambda x: x["raw"]), "").alias("text"), (F.min("i") + 1).cast("long").alias("start_line"))
    before = Window.partitionBy("run_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return b.withColumn("start_byte", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)).cast("long")).withColumn("sha256", F.sha2("text", 256)).drop("chunk")


@query(f"""WITH {_BATCH_SQL} SELECT run_id::VARCHAR AS run_id, (i + 1)::BIGINT AS line_number, sum(octet_length(encode(raw))) OVER (PARTITION BY run_id ORDER BY i)::BIGINT - octet_length(encode(raw)) AS byte_offset, octet_length(encode(raw)) AS byte_length, sha256(raw) AS raw_sha256 FROM l""")
def ndjson_lines(spark, sf_dir):
    d = ndjson.batch_lines(_batches(spark, sf_dir)).where("issue IS NULL")
    return d.select("run_id", F.col("line_number").cast("long").alias("line_number"), F.col("byte_offset").cast("long").alias("byte_offset"), "byte_length", "raw_sha256")


@query(f"""WITH RECURSIVE {_BATCH_SQL}, x AS (SELECT run_id, i // 20 AS chunk, i + 1 AS n, sum(octet_length(encode(raw))) OVER (PARTITION BY run_id ORDER BY i) - octet_length(encode(raw)) AS pos, octet_length(encode(raw)) AS size, sha256(raw) AS h FROM l),
m AS (SELECT run_id, chunk, sha256(string_agg(n || ':' || pos || ':' || size || ':' || h, chr(10) ORDER BY n)) AS manifest FROM x GROUP BY ALL),
s AS (SELECT o.*, o.start_byte || ':' || o.start_line || ':' || octet_length(encode(o.body)) || ':' || o.line_count || ':' || sha256(o.body) || ':' || manifest AS step, octet_length(encode(o.body)) AS bytes FROM o JOIN m USING (run_id, chunk)),
c AS (SELECT run_id, chunk, sha256('ndjson-chunks-v1|' || step) AS chain FROM s WHERE chunk = 0 UNION ALL SELECT s.run_id, s.chunk, sha256(c.chain || '|' || s.step) FROM c JOIN s ON s.run_id = c.run_id AND s.chunk = c.chunk + 1)
SELECT run_id::VARCHAR AS run_id, CASE WHEN run_id % 5 = 3 THEN 'CHECKPOINT_INCOMPLETE' ELSE 'READY' END AS state, sum(line_count)::BIGINT AS lines, CASE WHEN run_id % 5 <> 3 THEN arg_max(chain, chunk) END AS chain FROM s JOIN c USING (run_id, chunk) GROUP BY run_id""")
def ndjson_seal(spark, sf_dir):
    b = _batches(spark, sf_dir)
    c = ndjson.chunks_of(b, ndjson.batch_lines(b))
    size = c.groupBy("run_id").agg(F.sum("byte_length").alias("byte_length"))
    return ndjson.sealed(c, size.withColumn("byte_length", F.col("byte_length") + (F.col("run_id").cast("long") % 5 == 3).cast("long")))


@query("""WITH b AS (SELECT o_orderkey AS k, o_orderkey % 9 AS m FROM orders) SELECT k::VARCHAR AS run_id, CASE m WHEN 1 THEN 'HASH_OR_SIZE' WHEN 2 THEN 'FINAL_NEWLINE_REQUIRED' WHEN 3 THEN 'BLANK_LINE' WHEN 4 THEN 'BYTE_ORDER_MARK' WHEN 5 THEN 'REPEATED_KEY' WHEN 6 THEN 'INVALID_JSON' WHEN 7 THEN 'INVALID_JSON' END AS issue,
CASE WHEN m IN (1, 2) THEN 'line:7@byte:100' WHEN m BETWEEN 3 AND 7 THEN 'line:8@byte:' || (100 + 9 + length(k::VARCHAR)) END AS location FROM b""")
def ndjson_batch_issues(spark, sf_dir):
    m = F.col("o_orderkey") % 9
    second = F.when(m == 3, " \t\r").when(m == 4, "﻿{}").when(m == 5, '{"a":1,"a":2}').when(m == 6, "[1]").when(m == 7, '{"a":').otherwise('{"b":2}\r')
    text = F.concat(F.lit('{"id": '), "o_orderkey", F.lit("}\n"), second, F.when(m == 2, "").otherwise("\n"))
    b = t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("run_id"), F.lit(100).cast("long").alias("start_byte"), F.lit(7).cast("long").alias("start_line"), text.alias("text"))
    b = b.withColumn("sha256", F.when(F.col("run_id").cast("long") % 9 == 1, "0").otherwise(F.sha2("text", 256)))
    return ndjson.batch_issues(b, ndjson.batch_lines(b)).select("run_id", "issue", "location")


@query("""SELECT c_custkey::VARCHAR AS run_id, CASE WHEN c_custkey % 3 = 0 THEN 'NEW' WHEN c_custkey % 5 = 0 THEN 'REPLAY_CONFLICT' ELSE 'REPLAYED' END AS outcome FROM customer""")
def ndjson_replays(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("run_id"), F.lit(0).cast("long").alias("start_byte"), F.lit(1).cast("long").alias("start_line"), F.lit(5).cast("long").alias("byte_length"), F.sha2("c_name", 256).alias("sha256"))
    again = c.withColumn("sha256", F.when(F.col("run_id").cast("long") % 5 == 0, "other").otherwise(F.col("sha256")))
    return ndjson.replays(c.where("CAST(run_id AS bigint) % 3 <> 0"), again).select("run_id", "outcome")


@query("""WITH s AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS attempts, max(ts) AS last_at FROM events GROUP BY 1)
SELECT user_id, least(600 * 2 ** least(attempts, 30), 86400)::BIGINT AS wait_seconds FROM s WHERE floor(epoch(TIMESTAMP '2024-01-31 12:00:00') - epoch(date_trunc('second', last_at))) >= least(600 * 2 ** least(attempts, 30), 86400)""")
def polling_backoff(spark, sf_dir):
    s = t(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("attempts"), F.max("ts").alias("last_at"))
    return ndjson.due(s.withColumns({"interval_seconds": F.lit(600), "most_seconds": F.lit(86400)}), F.lit("2024-01-31 12:00:00").cast("timestamp")).select("user_id", "wait_seconds")


@query("SELECT event_type, CAST(max(ts) AS VARCHAR)[:19] AS watermark FROM events GROUP BY 1")
def source_watermarks(spark, sf_dir):
    return ndjson.source_watermark(t(spark, sf_dir, "events"), "event_type", "ts").select("event_type", F.date_format("watermark", "yyyy-MM-dd HH:mm:ss").alias("watermark"))


# --- paged sources, inputs, stores ---


@query("""WITH f AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE c_custkey % 250 END AS total FROM customer), p AS (SELECT id, n AS page_no, o AS ordinal FROM f, (SELECT unnest(range(1, 6)) AS n), (SELECT unnest([0, 1]) AS o) WHERE n <= greatest(ceil(total / 50.0), 1) AND (o = 0 OR total = 0))
SELECT id::VARCHAR AS partition_id, page_no, ordinal FROM p WHERE (id + page_no + ordinal) % 3 = 0""")
def missing_pages(spark, sf_dir):
    first = t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("partition_id"), F.when(F.col("c_custkey") % 4 == 0, 0).otherwise(F.col("c_custkey") % 250).alias("declared_total"))
    plan = paged.planned_requests(first, 50)
    return paged.missing_requests(plan, plan.where("(CAST(partition_id AS bigint) + page_no + ordinal) % 3 <> 0"))


@query("""SELECT o_orderkey AS id, 'DETAIL' AS kind FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, 'MISSING' FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 = 0""")
def index_to_detail(spark, sf_dir):
    o = t(spark, sf_dir, "orders", F.col("o_orderkey").alias("id"))
    got, lacking = paged.fan_out(o.where("id % 2 = 0").unionByName(o.where("id % 4 = 0")), o.where("id % 3 <> 0"), "id")
    return got.withColumn("kind", F.lit("DETAIL")).unionByName(lacking.withColumn("kind", F.lit("MISSING")))


@query("""SELECT o_custkey AS run_id, o_orderkey AS observation_id FROM orders WHERE o_custkey % 4 <> 1""")
def proven_run_inputs(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    seen = o.select(F.col("o_custkey").alias("snapshot_id"), F.col("o_orderkey").alias("observation_id"), F.sha2("o_orderpriority", 256).alias("content_sha256"))
    runs = seen.select("snapshot_id").distinct().withColumn("run_id", F.col("snapshot_id"))
    said = seen.withColumn("content_sha256", F.when(F.col("snapshot_id") % 4 == 1, "other").otherwise(F.col("content_sha256")))
    manifest = hashing.set_hash(said.withColumn("m", F.concat_ws(":", "observation_id", "content_sha256")).withColumnRenamed("snapshot_id", "run_id"), ["run_id"], "m").select("run_id", "set_hash")
    return paged.run_inputs(runs, seen, manifest).select("run_id", "observation_id")


@query("""SELECT code, CASE WHEN n > 0 THEN 'DERIVED' ELSE 'MISSING' END AS kind FROM (SELECT a.code, count(p.p_brand) AS n FROM (SELECT DISTINCT p_brand AS code FROM part UNION SELECT 'Brand#0') a LEFT JOIN (SELECT p_brand FROM part WHERE p_size > 40) p ON p.p_brand = a.code GROUP BY 1)""")
def derived_partition_codes(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    allowed = p.select("p_brand").distinct().union(spark.createDataFrame([("Brand#0",)], "c string"))
    own, lacking = paged.derived_codes(p.where("p_size > 40"), "p_brand", allowed, "^Brand#[0-9]+$")
    return own.withColumn("kind", F.lit("DERIVED")).unionByName(lacking.withColumn("kind", F.lit("MISSING")))


@query("""SELECT sha256(text) AS sha256, min('raw/sha256/' || sha256(text)[1:2] || '/' || sha256(text)[3:4] || '/' || sha256(text)) AS path, count(*) AS copies FROM documents WHERE text IS NOT NULL AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL) GROUP BY 1""")
def content_store_additions(spark, sf_dir):
    d = t(spark, sf_dir, "documents", "doc_id", F.encode("text", "UTF-8").alias("content"))
    old = sinks.content_rows(d.where("doc_id % 3 = 0"), "content")
    new = sinks.store_additions(old, sinks.content_rows(d, "content"))
    return new.select("sha256", "path", "copies")


@query("""SELECT o_custkey AS source, o_orderkey AS run, CASE WHEN o_orderkey % 3 = 0 THEN 'ARCHIVED' ELSE 'KEPT' END AS fate FROM orders""")
def archive_by_manifest(spark, sf_dir):
    o = t(spark, sf_dir, "orders", F.col("o_custkey").alias("source"), F.col("o_orderkey").alias("run"))
    gone, kept = sinks.archive(o, o.where("run % 3 = 0"), ["run"])
    return gone.withColumn("fate", F.lit("ARCHIVED")).unionByName(kept.withColumn("fate", F.lit("KEPT")))
