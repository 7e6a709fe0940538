"""The operators over the driver's tables, with equal SQL: one query for each family of the inventory."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import hashing, temporal, text
from ..operators import assembly, cohort, demand, evaluate, graph, ledger, lifecycle, quality, retrieval, rules
from ..sources import documents as documents_
from ..sources import readers
from .registry import query, t

def cents(c):
    """Money as exact decimal, so that sums don't depend on order."""
    return F.col(c).cast("decimal(18,2)")


# --- ledger: latest rows, cut-offs, differences ---


@query("SELECT user_id, event_id, event_type, CAST(value AS DOUBLE) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_event_per_user(spark, sf_dir):
    return ledger.latest_by(t(spark, sf_dir, "events", "user_id", "event_id", "event_type", "value", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events WHERE event_id <= 5000) WHERE r = 1")
def cutoff_latest_event(spark, sf_dir):
    return ledger.as_of(t(spark, sf_dir, "events", "user_id", "event_id"), ["user_id"], ["event_id"], "event_id", 5000)


@query("""SELECT c.event_id, coalesce(p.event_id, -1) AS asof_purchase_id FROM (SELECT * FROM events WHERE event_type = 'click') c
ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY ALL) p ON c.user_id = p.user_id AND c.ts >= p.ts""")
def asof_last_purchase(spark, sf_dir):
    e = t(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type")
    bought = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("purchase_id"))
    return ledger.as_of_join(e.where("event_type = 'click'").drop("event_type"), bought, "user_id", "ts", "at", "purchase_id").select("event_id", F.coalesce("asof_purchase_id", F.lit(-1)).alias("asof_purchase_id"))


_DERIVED = "SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 101 <> 0"


@query(f"""WITH a AS (SELECT o_orderkey, o_orderstatus FROM orders), b AS ({_DERIVED})
SELECT *, 'MISSING' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'UNEXPECTED' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def symmetric_diff_orders(spark, sf_dir):
    a = t(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    b = a.where("o_orderkey % 101 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 97 == 0, "X").otherwise(F.col("o_orderstatus")))
    return ledger.symmetric_difference(a, b)


@query("""SELECT *, 'MISSING' AS side FROM (SELECT l_returnflag, l_linenumber::BIGINT AS l_linenumber FROM lineitem EXCEPT ALL SELECT l_returnflag, l_linenumber::BIGINT FROM lineitem WHERE l_orderkey % 1000 <> 0)""")
def bag_diff_lines(spark, sf_dir):
    a = t(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", F.col("l_linenumber").cast("long").alias("l_linenumber"))
    return ledger.symmetric_difference(a.drop("l_orderkey"), a.where("l_orderkey % 1000 <> 0").drop("l_orderkey"), bag=True)


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 UNION ALL
SELECT o_orderkey, o_orderstatus FROM orders o WHERE o_orderkey % 2 = 0 AND NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderkey % 3 = 0 AND e.o_orderkey = o.o_orderkey)""")
def append_only_orders(spark, sf_dir):
    o = t(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    old = o.where("o_orderkey % 3 = 0")
    return old.unionByName(ledger.new_rows(old, o.where("o_orderkey % 2 = 0"), ["o_orderkey"]))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 10 = 0")
def immutable_conflict_customers(spark, sf_dir):
    c = t(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    changed = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 10 == 0, "OTHER").otherwise(F.col("c_mktsegment")))
    return ledger.immutable_conflicts(c, changed, ["c_custkey"], "c_mktsegment").select("c_custkey", F.col("existing_content").alias("c_mktsegment"))


@query("""WITH u AS (SELECT user_id, event_id, ts FROM events WHERE event_id < 6000 UNION ALL SELECT user_id, event_id, ts FROM events WHERE event_id >= 4000)
SELECT user_id, max(event_id) AS event_id FROM (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM u) WHERE r = 1 GROUP BY user_id""")
def upsert_latest_event(spark, sf_dir):
    e = t(spark, sf_dir, "events", "user_id", "event_id", "ts")
    return ledger.upsert_latest(e.where("event_id < 6000"), e.where("event_id >= 4000"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id")


@query("""SELECT s, r.o_orderkey FROM (SELECT DISTINCT c_nationkey AS s FROM customer) JOIN LATERAL
(SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = s AND o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) r ON true""")
def latest_ready_snapshot(spark, sf_dir):
    c = t(spark, sf_dir, "customer", F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("source_id"))
    runs = t(spark, sf_dir, "orders").join(c, "o_custkey").select(
        "source_id", F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("created_at"), F.when(F.col("o_orderstatus") == "F", "READY").otherwise("OPEN").alias("state"), F.when(F.col("o_orderpriority") == "5-LOW", "SMOKE").otherwise("FULL").alias("mode")
    )
    return ledger.latest_ready_run(runs).select(F.col("source_id").alias("s"), F.col("run_id").alias("o_orderkey"))


# --- hashing ---


@query("""SELECT c_nationkey::BIGINT AS nation, sha256(string_agg(c_custkey::VARCHAR, chr(10) ORDER BY c_custkey::VARCHAR)) AS set_hash FROM customer GROUP BY 1""")
def plain_set_hash(spark, sf_dir):
    return t(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("long").alias("nation")).agg(hashing.plain_set_hash(F.col("c_custkey")).alias("set_hash"))


@query("SELECT c_mktsegment, count(DISTINCT c_custkey) AS members FROM customer GROUP BY 1")
def bucketed_set_hash(spark, sf_dir):
    a = hashing.set_hash(t(spark, sf_dir, "customer"), ["c_mktsegment"], "c_custkey")
    b = hashing.set_hash(t(spark, sf_dir, "customer").repartition(7, "c_name"), ["c_mktsegment"], "c_custkey")
    return a.join(b, ["c_mktsegment", "members", "set_hash"]).select("c_mktsegment", F.col("members").cast("long").alias("members"))


@query("""SELECT r_regionkey::BIGINT AS r_regionkey, sha256('row-v1:{"r_name":"' || r_name || '","r_regionkey":' || r_regionkey || '}') AS content_hash FROM region""")
def canonical_row_hash(spark, sf_dir):
    return t(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("r_regionkey"), hashing.row_hash("r_regionkey", "r_name").alias("content_hash"))


@query("""WITH RECURSIVE n AS (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS k, n_nationkey FROM nation),
c AS (SELECT n_regionkey, k, n_nationkey, sha256('|' || n_name) AS chain FROM n WHERE k = 1
UNION ALL SELECT n.n_regionkey, n.k, n.n_nationkey, sha256(c.chain || '|' || n.n_name) FROM c JOIN n ON n.n_regionkey = c.n_regionkey AND n.k = c.k + 1)
SELECT n_nationkey::BIGINT AS n_nationkey, chain FROM c""")
def chunk_hash_chain(spark, sf_dir):
    return hashing.hash_chain(t(spark, sf_dir, "nation"), "n_regionkey", "n_nationkey", "n_name").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "chain")


# --- assembly ---


def _records(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    shown = F.struct(F.lit("list").alias("representation"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    detail = F.struct(F.lit("detail").alias("representation"), F.when(F.col("o_orderkey") % 5 == 0, "Z").alias("status"), F.when(F.col("o_orderkey") % 2 == 0, F.upper("o_orderpriority")).alias("priority"))
    return o.select(F.col("o_orderkey").alias("posting_id"), F.explode(F.array(shown, detail)).alias("r")).select("posting_id", "r.*", F.hash("r").alias("record_id"))


@query("""SELECT o_orderkey AS posting_id, CASE WHEN o_orderkey % 5 = 0 THEN 'Z' ELSE o_orderstatus END AS status,
CASE WHEN o_orderkey % 2 = 0 THEN upper(o_orderpriority) ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 5 = 0 THEN 'detail' ELSE 'list' END AS status_origin, 1::BIGINT AS n_list, 1::BIGINT AS n_detail FROM orders""")
def merge_list_detail(spark, sf_dir):
    m = assembly.merge_list_detail(_records(spark, sf_dir), ["posting_id"], ["status", "priority"])
    return m.select("posting_id", "status", "priority", F.col("origin")["status"].alias("status_origin"), "n_list", "n_detail")


@query("SELECT o_orderkey AS posting_id, o_orderstatus AS list_value, 'Z' AS detail_value FROM orders WHERE o_orderkey % 5 = 0")
def conflict_pairs(spark, sf_dir):
    return assembly.conflict_values(_records(spark, sf_dir), "posting_id", "status")


@query("""WITH n AS (SELECT p_type, p_name, count(*) AS n FROM part GROUP BY ALL) SELECT p_type, label FROM (SELECT p_type, p_name AS label, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_name) AS r FROM n) WHERE r = 1""")
def label_by_frequency(spark, sf_dir):
    return assembly.choose_label(t(spark, sf_dir, "part").withColumn("priority", F.lit(1)), "p_type", "p_name", "priority").select("p_type", "label")


@query("""SELECT o_custkey, arg_min(o_orderkey, (o_orderpriority, o_orderkey)) AS by_priority, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS by_date FROM orders GROUP BY 1""")
def golden_record_owners(spark, sf_dir):
    o = t(spark, sf_dir, "orders").withColumns({"by_priority": F.col("o_orderkey"), "by_date": F.col("o_orderkey")})
    return assembly.golden_record(o, "o_custkey", ["by_priority", "by_date"], {"by_priority": ["o_orderpriority", "o_orderkey"], "by_date": ["o_orderdate", "o_orderkey"]})


@query("""WITH c AS (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM role AND row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 1 THEN 0 ELSE 1 END AS ch FROM conversations)
SELECT conv_id, turn, CAST(sum(ch) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM c""")
def gaps_islands_turns(spark, sf_dir):
    return assembly.islands(t(spark, sf_dir, "conversations", "conv_id", "turn", "role"), "conv_id", "turn", "role").select("conv_id", "turn", F.col("island").cast("long").alias("island"))


# --- quality ---


@query("SELECT l_orderkey, count(*) AS n, (count(DISTINCT l_linenumber) = count(*) AND min(l_linenumber) = 1 AND max(l_linenumber) = count(*)) AS complete FROM lineitem GROUP BY 1")
def partition_completeness(spark, sf_dir):
    return quality.contiguous(t(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


_PAGES = """SELECT c_custkey AS k, CASE WHEN c_custkey % 13 = 3 AND n = 2 THEN 1 ELSE n END AS page_no, CASE WHEN c_custkey % 13 = 4 AND n = 2 THEN 20 ELSE 10 END AS page_size,
CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_custkey % 37 + 1 END AS declared_total, CASE WHEN c_custkey % 5 = 0 THEN (CASE WHEN c_custkey % 13 = 6 THEN 1 ELSE 0 END) ELSE least(10, c_custkey % 37 + 1 - (n - 1) * 10) - CASE WHEN c_custkey % 13 = 5 THEN 1 ELSE 0 END END AS item_count,
CASE WHEN c_custkey % 5 = 0 THEN (CASE WHEN c_custkey % 13 = 7 THEN 1 ELSE n - 1 END) ELSE 0 END AS ordinal FROM customer, {n} WHERE n <= CASE WHEN c_custkey % 5 = 0 THEN 2 - (c_custkey % 13 = 8)::INT ELSE ceil((c_custkey % 37 + 1) / 10.0) + (c_custkey % 13 = 9)::INT END"""


@query(f"""WITH p AS ({_PAGES.format(n="(SELECT unnest(range(1, 7)) AS n)")}), a AS (SELECT k, count(*) AS pages, list_sort(list(page_no)) AS nos, min(declared_total) AS total, min(page_size) AS lo, max(page_size) AS hi, list_sort(list(ordinal)) AS turns,
bool_and(item_count = least(page_size, declared_total - (page_no - 1) * page_size) AND ordinal = 0) AS is_full, bool_and(page_no = 1 AND item_count = 0) AS is_empty FROM p GROUP BY 1)
SELECT k, pages, CASE WHEN total = 0 THEN 2 ELSE ceil(total / lo) END::BIGINT AS expected, CASE WHEN lo <> hi THEN 'UNSTABLE_PAGINATION' WHEN total = 0 THEN (CASE WHEN pages = 2 AND is_empty AND turns = [0, 1] THEN NULL ELSE 'EMPTY_NOT_CONFIRMED' END)
WHEN nos <> range(1, ceil(total / lo)::BIGINT + 1) THEN 'PAGES_MISSING_OR_REPEATED' WHEN NOT is_full THEN 'PAGE_ROW_COUNT' END AS reason FROM a""")
def page_completeness(spark, sf_dir):
    c = t(spark, sf_dir, "customer", F.col("c_custkey").alias("k"), F.explode(F.sequence(F.lit(1), F.lit(6))).alias("n"))
    empty, of, odd = F.col("k") % 5 == 0, F.col("k") % 37 + 1, lambda x: F.col("k") % 13 == x
    c = c.where(F.col("n") <= F.when(empty, 2 - odd(8).cast("int")).otherwise(F.ceil(of / 10) + odd(9).cast("int")))
    pages = c.select(
        "k", F.when(odd(3) & (F.col("n") == 2), 1).otherwise(F.col("n")).alias("page_no"), F.when(odd(4) & (F.col("n") == 2), 20).otherwise(10).alias("page_size"), F.when(empty, 0).otherwise(of).alias("declared_total"),
        F.when(empty, odd(6).cast("long")).otherwise(F.least(F.lit(10), of - (F.col("n") - 1) * 10) - odd(5).cast("int")).alias("item_count"), F.when(empty, F.when(odd(7), 1).otherwise(F.col("n") - 1)).otherwise(0).alias("ordinal"),
    )
    return quality.page_completeness(pages, ["k"], ordinal="ordinal")


@query("""SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'DETAIL_ONLY' ELSE 'LIST_ONLY' END AS side FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 11 <> 0) a
FULL JOIN (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 7 <> 0) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def list_detail_identities(spark, sf_dir):
    o = t(spark, sf_dir, "orders", F.col("o_orderkey").alias("k"))
    return quality.list_detail_mismatch(o.where("k % 11 <> 0"), o.where("k % 7 <> 0"), "k")


@query("""SELECT 'NO_CUSTOMER' AS issue, o_orderkey::VARCHAR AS location FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'NO_LINES', o_orderkey::VARCHAR FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
UNION ALL SELECT 'REPEATED_LINE', l_orderkey || ':' || l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'NEGATIVE_BALANCE', c_custkey::VARCHAR FROM customer WHERE c_acctbal < 0""")
def issue_bag_orders(spark, sf_dir):
    o, li, c = (t(spark, sf_dir, n) for n in ("orders", "lineitem", "customer"))
    return quality.issue_bag(
        {
            "NO_CUSTOMER": o.join(c.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti").withColumn("location", F.col("o_orderkey")),
            "NO_LINES": o.join(li.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").withColumn("location", F.col("o_orderkey")),
            "REPEATED_LINE": li.groupBy("l_orderkey", "l_linenumber").count().where("count > 1").withColumn("location", F.concat_ws(":", "l_orderkey", "l_linenumber")),
            "NEGATIVE_BALANCE": c.where("c_acctbal < 0").withColumn("location", F.col("c_custkey")),
        }
    )


@query("SELECT CASE WHEN l_quantity > 45 THEN 'QUANTITY' WHEN l_discount > 0.08 THEN 'DISCOUNT' END AS error_code, count(*) AS n FROM lineitem WHERE l_quantity > 45 OR l_discount > 0.08 GROUP BY 1")
def quarantine_lines(spark, sf_dir):
    _, bad = quality.quarantine(t(spark, sf_dir, "lineitem"), {"QUANTITY": F.col("l_quantity") > 45, "DISCOUNT": F.col("l_discount") > 0.08})
    return bad.groupBy("error_code").agg(F.count("*").alias("n"))


@query("""SELECT k, unnest(list_filter(['' || CASE WHEN b.k2 IS NULL THEN 'ONLY_LIST' END, CASE WHEN a.k1 IS NULL THEN 'ONLY_DETAIL' END, CASE WHEN a.s <> b.s THEN 'DIFFERS_S' END], lambda x: x IS NOT NULL)) AS issue FROM (
SELECT coalesce(a.k, b.k) AS k, a, b FROM (SELECT o_orderkey AS k, {'k1': o_orderkey, 's': o_orderstatus} AS a FROM orders WHERE o_orderkey % 11 <> 0) a FULL JOIN
(SELECT o_orderkey AS k, {'k2': o_orderkey, 's': CASE WHEN o_orderkey % 13 = 0 THEN 'Q' ELSE o_orderstatus END} AS b FROM orders WHERE o_orderkey % 7 <> 0) b ON a.k = b.k)""")
def full_outer_pair_diff(spark, sf_dir):
    o = t(spark, sf_dir, "orders", F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    return quality.pair_consistency(o.where("k % 11 <> 0"), o.where("k % 7 <> 0").withColumn("s", F.when(F.col("k") % 13 == 0, "Q").otherwise(F.col("s"))), "k", ["s"])


@query("""SELECT 'c_mktsegment' AS field, count(*) AS rows, count(*) - count(c_mktsegment) AS nulls, count(DISTINCT c_mktsegment) AS distinct_values FROM customer
UNION ALL SELECT 'c_nationkey', count(*), count(*) - count(c_nationkey), count(DISTINCT c_nationkey) FROM customer""")
def field_profile(spark, sf_dir):
    return quality.profile(t(spark, sf_dir, "customer", "c_mktsegment", "c_nationkey"), ["c_mktsegment", "c_nationkey"])


# --- lifecycle ---


@query("""WITH r AS (SELECT run, row_number() OVER (ORDER BY run) AS ordinal FROM (SELECT DISTINCT ts::DATE AS run FROM events)),
s AS (SELECT user_id, min(ordinal) AS first_run, max(ordinal) AS last_run FROM (SELECT DISTINCT user_id, ts::DATE AS run FROM events) JOIN r USING (run) GROUP BY 1)
SELECT user_id, first_run, last_run, (SELECT max(ordinal) FROM r) - last_run AS absences, CASE WHEN user_id % 10 = 0 THEN 'CLOSED' WHEN user_id % 10 = 1 THEN 'EXPIRED' WHEN (SELECT max(ordinal) FROM r) - last_run >= 2 THEN 'NOT_SEEN' ELSE 'ACTIVE' END AS status FROM s""")
def absence_lifecycle(spark, sf_dir):
    e = t(spark, sf_dir, "events", "user_id", F.to_date("ts").alias("run")).distinct().withColumn("source", F.lit("events"))
    runs = e.select("source", "run").distinct().withColumn("ordinal", F.row_number().over(Window.partitionBy("source").orderBy("run")).cast("long"))
    state = e.select("user_id").distinct().withColumns({"closed": F.col("user_id") % 10 == 0, "expired": F.col("user_id") % 10 == 1})
    return lifecycle.absence_lifecycle(e, runs, "source", "user_id", "run", state).drop("source")


@query("""WITH r AS (SELECT event_type AS source_id, ts, event_id, CASE WHEN value < 5 THEN 'FAILED' ELSE 'READY' END AS state FROM events),
a AS (SELECT source_id, arg_max(state, (ts, event_id)) AS last_state, max(CASE WHEN state = 'READY' THEN ts END) AS ready_at FROM r GROUP BY 1)
SELECT source_id, CASE WHEN ready_at IS NULL THEN 'REVIEW' WHEN last_state = 'FAILED' THEN 'ERROR' WHEN floor(epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(date_trunc('second', ready_at))) > 1200 THEN 'STALE' ELSE 'FRESH' END AS status FROM a""")
def source_health(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(F.col("event_type").alias("source_id"), F.col("ts").alias("created_at"), F.col("event_id").alias("run_id"), F.when(F.col("value") < 5, "FAILED").otherwise("READY").alias("state"))
    return lifecycle.source_health(e.select("source_id").distinct().withColumn("max_age", F.lit(1200)), e, "2024-01-31 00:00:00").select("source_id", "status")


@query("SELECT user_id, CAST((min(ts) + INTERVAL 9 HOUR)::DATE AS VARCHAR) AS first_day, CAST((max(ts) + INTERVAL 9 HOUR)::DATE AS VARCHAR) AS last_day, arg_max(event_id, (ts, event_id)) AS last_id FROM events GROUP BY 1")
def first_last_event_dates(spark, sf_dir):
    d = lifecycle.ingestion_dates(t(spark, sf_dir, "events"), "user_id", "ts", "event_id")
    return d.withColumns({"first_day": F.col("first_day").cast("string"), "last_day": F.col("last_day").cast("string")})


@query("""WITH r AS (SELECT o_custkey AS source_id, o_orderkey AS run_id, o_orderdate AS created_at, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k, o_orderstatus = 'P' AS p FROM orders),
c AS (SELECT source_id, run_id FROM r WHERE k > 3 AND NOT p ORDER BY created_at, run_id LIMIT 500)
SELECT r.source_id, r.run_id, concat_ws(',', CASE WHEN k <= 3 THEN 'KEEP_LATEST(3)' END, CASE WHEN p THEN 'LLM_BATCH' END) AS protections, c.run_id IS NOT NULL AS selected FROM r LEFT JOIN c USING (source_id, run_id)""")
def retention_plan(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source_id"), F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("created_at"), "o_orderstatus")
    return lifecycle.retention_plan(o, 3, {"LLM_BATCH": F.col("o_orderstatus") == "P"}, oldest=500).select("source_id", "run_id", F.array_join("protections", ",").alias("protections"), "selected")


@query("""WITH r AS (SELECT user_id AS source_id, max(ts) AS ready_at FROM events WHERE event_type = 'view' GROUP BY 1), f AS (SELECT user_id AS source_id, max(ts) AS failed_at FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT s.source_id, CASE WHEN ready_at IS NULL THEN 'NEVER' ELSE 'INTERVAL' END AS reason FROM (SELECT DISTINCT user_id AS source_id FROM events) s LEFT JOIN r USING (source_id) LEFT JOIN f USING (source_id)
WHERE (ready_at IS NULL OR floor(epoch(TIMESTAMP '2024-01-31') - epoch(date_trunc('second', ready_at))) > 86400) AND NOT coalesce(floor(epoch(TIMESTAMP '2024-01-31') - epoch(date_trunc('second', failed_at))) < 43200, false)""")
def refresh_queue(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), "ts", "event_type")
    s = e.select("source_id").distinct().withColumns({"enabled": F.lit(True), "interval_seconds": F.lit(86400), "retry_seconds": F.lit(43200)})
    return lifecycle.refresh_queue(s, e.where("event_type = 'view'").select("source_id", F.col("ts").alias("created_at"), F.lit("READY").alias("state")), e.where("event_type = 'error'").select("source_id", F.col("ts").alias("failed_at")), "2024-01-31 00:00:00")


@query("SELECT event_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS BIGINT) AS used FROM events")
def rolling_24h_quota(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumn("cost", F.round(F.col("value") * 100).cast("long"))
    return lifecycle.rolling_usage(e, "user_id", "ts", "cost", 86_400).select("event_id", "used")


# --- cohort and review ---


@query("""WITH p AS (SELECT *, list_sort(list_filter([CASE WHEN o_orderdate < DATE '2001-08-01' - INTERVAL 179 DAY THEN 'BEFORE_WINDOW' END, CASE WHEN o_orderdate > DATE '2001-08-01' THEN 'AFTER_AS_OF' END, CASE WHEN o_orderstatus = 'P' THEN 'SOURCE_OUTSIDE_SCOPE' END], lambda x: x IS NOT NULL)) AS rs FROM orders),
b AS (SELECT o_custkey, arg_min(o_orderkey, (-epoch(o_orderdate), o_orderkey)) AS best FROM p WHERE len(rs) = 0 GROUP BY 1)
SELECT o_orderkey, CASE WHEN len(rs) > 0 THEN 'EXCLUDED' WHEN o_orderkey = best THEN 'INCLUDED' ELSE 'DUPLICATE' END AS outcome,
CASE WHEN len(rs) > 0 THEN array_to_string(rs, ',') WHEN o_orderkey = best THEN '' ELSE 'DUPLICATE_NON_REPRESENTATIVE' END AS reasons FROM p LEFT JOIN b USING (o_custkey)""")
def cohort_180d(spark, sf_dir):
    o, as_of = t(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate")), F.lit("2001-08-01").cast("date")
    reasons = {"BEFORE_WINDOW": F.col("day") < F.date_sub(as_of, 179), "AFTER_AS_OF": F.col("day") > as_of, "SOURCE_OUTSIDE_SCOPE": F.col("o_orderstatus") == "P"}
    c = cohort.cohort(o, reasons, "o_custkey", [-F.unix_timestamp("o_orderdate"), F.col("o_orderkey")], "o_orderkey")
    return c.select("o_orderkey", "outcome", F.array_join("reasons", ",").alias("reasons"))


@query("SELECT value, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN l_quantity > 40 THEN 'A' END, CASE WHEN l_tax > 0.05 THEN 'B' END], lambda x: x IS NOT NULL)) AS value FROM lineitem) GROUP BY 1")
def exclusion_histogram(spark, sf_dir):
    return cohort.histogram(quality.with_reasons(t(spark, sf_dir, "lineitem"), {"A": F.col("l_quantity") > 40, "B": F.col("l_tax") > 0.05}), "reasons")


@query("""WITH p AS (SELECT o_custkey AS k, max(o_orderkey) AS pid FROM orders WHERE o_orderkey <= 12000 GROUP BY 1),
d AS (SELECT l_orderkey AS pid, arg_max(CASE WHEN l_returnflag = 'R' THEN 'REJECT' WHEN l_returnflag = 'A' THEN 'ACCEPT' ELSE 'NOTE' END, l_linenumber) AS decision FROM (SELECT * FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1) WHERE l_linenumber <= 5 GROUP BY 1)
SELECT k, pid AS proposal_id, CASE decision WHEN 'REJECT' THEN 'REJECTED' WHEN 'ACCEPT' THEN 'ACCEPTED' ELSE 'PENDING' END AS status FROM p LEFT JOIN d USING (pid)""")
def review_ledger_status(spark, sf_dir):
    p = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("proposal_id"), F.col("o_orderkey").alias("proposal_no"), F.lit("a").alias("proposer"))
    once = Window.partitionBy("l_orderkey", "l_linenumber")
    li = t(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag").withColumn("c", F.count("*").over(once)).where("c = 1")
    d = li.select(F.col("l_orderkey").alias("proposal_id"), F.col("l_linenumber").cast("long").alias("decision_id"), F.when(F.col("l_returnflag") == "R", "REJECT").when(F.col("l_returnflag") == "A", "ACCEPT").otherwise("NOTE").alias("decision"), F.lit("b").alias("reviewer"))
    return cohort.review_status(p, d, "k", 12000, 5)


# --- demand, feeds, pages ---


@query("""SELECT n_name AS region, p_brand AS code, count(DISTINCT l_orderkey) AS postings, count(*) AS links FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
GROUP BY 1, 2 ORDER BY postings DESC, links DESC, region, code LIMIT 50""")
def region_demand_topk(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey")
    d = li.join(t(spark, sf_dir, "part", F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("code")), "l_partkey").join(t(spark, sf_dir, "supplier", F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    d = d.join(t(spark, sf_dir, "nation", F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("region")), "s_nationkey")
    a = d.groupBy("region", "code").agg(F.count_distinct("l_orderkey").alias("postings"), F.count("*").alias("links"))
    return demand.page(a, [F.desc("postings"), F.desc("links"), F.asc("region"), F.asc("code")], 50)


@query("""WITH d AS (SELECT p_brand AS code, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS r FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT code, count(DISTINCT l_orderkey) AS postings, count(*) AS links, string_agg(CASE WHEN r <= 3 THEN l_orderkey || ':' || l_linenumber END, ',' ORDER BY r) AS evidence FROM d GROUP BY 1""")
def demand_with_evidence(spark, sf_dir):
    d = t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "part", F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("code")), "l_partkey")
    a = demand.demand(d, "code", "l_orderkey", ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"])
    return a.withColumn("evidence", F.array_join(F.transform("evidence", lambda x: F.concat_ws(":", x["l_orderkey"], x["l_linenumber"])), ","))


_MERGED = """SELECT o_orderkey AS posting_id, CASE WHEN o_orderkey % 5 = 0 THEN 'Z' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 2 = 0 THEN upper(o_orderpriority) ELSE o_orderpriority END AS priority, o_orderdate, o_custkey FROM orders"""


@query(f"""SELECT posting_id, status, priority, CAST(o_orderdate AS VARCHAR)[:10] AS day FROM ({_MERGED}) JOIN customer ON c_custkey = o_custkey
WHERE contains(lower(priority), 'high') AND c_mktsegment = 'BUILDING' AND o_orderdate <= DATE '2000-01-01' ORDER BY o_orderdate DESC, posting_id LIMIT 100""")
def live_feed_page(spark, sf_dir):
    p = assembly.merge_list_detail(_records(spark, sf_dir), ["posting_id"], ["status", "priority"])
    o = t(spark, sf_dir, "orders", F.col("o_orderkey").alias("posting_id"), "o_orderdate", "o_custkey").join(t(spark, sf_dir, "customer", F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("region")), "o_custkey")
    d = demand.feed(p.join(o, "posting_id"), q="high", region="BUILDING", text="priority", open_filter=temporal.open_on(F.lit("2000-01-01").cast("date"), F.to_date("o_orderdate"), F.lit(None).cast("date"), F.lit(False)))
    return demand.page(d, [F.desc("o_orderdate"), F.asc("posting_id")], 100).select("posting_id", "status", "priority", F.to_date("o_orderdate").cast("string").alias("day"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 51")
def keyset_page(spark, sf_dir):
    return demand.keyset_page(t(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus"), "o_orderkey", 1000, 50)


@query("""SELECT o_orderkey, CAST(least(o_orderdate, o_orderdate + INTERVAL (o_orderkey % 9) DAY)::DATE AS VARCHAR) AS first_date FROM orders
WHERE o_orderdate BETWEEN DATE '1999-03-01' AND DATE '1999-03-31' OR (o_orderkey % 3 <> 0 AND o_orderdate + INTERVAL (o_orderkey % 9) DAY BETWEEN DATE '1999-03-01' AND DATE '1999-03-31')""")
def exam_session_feed(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("a"), F.when(F.col("o_orderkey") % 3 != 0, F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 9).cast("int"))).alias("b"))
    d = demand.exam_feed(o, ["a", "b"], "1999-03-01", "1999-03-31")
    return d.select("o_orderkey", F.col("first_date").cast("string").alias("first_date"))


@query("""WITH a AS (SELECT DISTINCT l_orderkey, p_brand AS l FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type = 'ECONOMY'), b AS (SELECT DISTINCT l_orderkey, p_brand AS r FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type = 'PROMO')
SELECT l AS left_code, r AS right_code, count(*) AS shared FROM a JOIN b USING (l_orderkey) GROUP BY 1, 2 HAVING count(*) >= 2""")
def crosswalk_co_occurrence(spark, sf_dir):
    d = t(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey").join(t(spark, sf_dir, "part", F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand"), "l_partkey")
    return demand.co_occurrence(d, "l_orderkey", "p_type", "p_brand", "ECONOMY", "PROMO", least=2)


@query("SELECT status, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'UNKNOWN' WHEN o_orderkey % 2 = 0 THEN 'CURRENT' ELSE 'STALE' END AS status FROM orders) GROUP BY 1")
def freshness_summary(spark, sf_dir):
    o = t(spark, sf_dir, "orders", "o_orderkey")
    stored = F.when(F.col("o_orderkey") % 5 != 0, F.when(F.col("o_orderkey") % 2 == 0, "h").otherwise("g"))
    return o.groupBy(demand.freshness(stored, F.lit("h")).alias("status")).agg(F.count("*").alias("n"))


# --- relational forms ---


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def semi_join_customers(spark, sf_dir):
    return t(spark, sf_dir, "customer", "c_custkey").join(t(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def anti_join_customers(spark, sf_dir):
    return t(spark, sf_dir, "customer", "c_custkey").join(t(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("SELECT l_returnflag, count(DISTINCT (l_suppkey, l_linestatus)) AS pairs FROM lineitem GROUP BY 1")
def tuple_count_distinct(spark, sf_dir):
    return t(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_distinct(F.struct("l_suppkey", "l_linestatus")).alias("pairs"))


@query("""SELECT c_nationkey::BIGINT AS nation, string_agg(c_mktsegment || '=' || n, ',' ORDER BY c_mktsegment) AS histogram FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL) GROUP BY 1""")
def segment_histogram_map(spark, sf_dir):
    n = t(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("long").alias("nation"), "c_mktsegment").agg(F.count("*").alias("n"))
    m = n.groupBy("nation").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("c_mktsegment", "n")))).alias("m"))
    return m.select("nation", F.array_join(F.transform(F.map_entries("m"), lambda x: F.concat_ws("=", x["key"], x["value"])), ",").alias("histogram"))


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_base_price, count(*) AS count_order,
count(*) FILTER (WHERE l_discount > 0.05) AS discounted, bool_or(l_tax > 0.07) AS any_tax, bool_and(l_quantity > 0) AS all_positive FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02' GROUP BY 1, 2""")
def conditional_aggregates(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp'2001-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").cast("long").alias("sum_qty"), F.sum(cents("l_extendedprice")).cast("double").alias("sum_base_price"), F.count("*").alias("count_order"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.bool_or(F.col("l_tax") > 0.07).alias("any_tax"), F.bool_and(F.col("l_quantity") > 0).alias("all_positive")
    )


@query("SELECT n_name, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS segments FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1 HAVING count(*) > 50")
def ordered_string_agg_having(spark, sf_dir):
    c = t(spark, sf_dir, "customer").join(t(spark, sf_dir, "nation", F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    return c.groupBy("n_name").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), "|").alias("segments"), F.count("*").alias("n")).where("n > 50").drop("n")


@query("SELECT CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS closed, round(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / nullif(count(*), 0)::DOUBLE, 6) AS share FROM orders HAVING count(*) > 0")
def global_ratio(spark, sf_dir):
    return t(spark, sf_dir, "orders").agg(F.count_if(F.col("o_orderstatus") == "F").alias("closed"), F.count("*").alias("n")).where("n > 0").select("closed", F.round(F.try_divide("closed", "n"), 6).alias("share"))


@query("SELECT a.part_id AS part_id, b.event_id FROM (SELECT l_orderkey * 10 + l_linenumber AS part_id, l_suppkey AS k, (l_partkey % 500) AS s, (l_partkey % 500) + l_linenumber * 3 AS e FROM lineitem) a JOIN (SELECT event_id, user_id AS k, event_id % 500 AS s, event_id % 500 + 5 AS e FROM events) b ON a.k = b.k AND a.s < b.e AND b.s < a.e")
def range_overlap_join(spark, sf_dir):
    a = t(spark, sf_dir, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS part_id", "l_suppkey AS k", "l_partkey % 500 AS s", "l_partkey % 500 + l_linenumber * 3 AS e")
    b = t(spark, sf_dir, "events").selectExpr("event_id", "user_id AS k", "event_id % 500 AS s", "event_id % 500 + 5 AS e")
    return rules.range_overlap(a, b, "k", "s", "e", 32).select(F.col("l.part_id").alias("part_id"), F.col("r.event_id").alias("event_id"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_props_typed(spark, sf_dir):
    return t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k")).where("k IS NOT NULL")


# --- text and retrieval ---


@query("""SELECT doc_id, (i - 1)::BIGINT AS n, (1 + coalesce(list_sum([length(l) + 1 for l in ls[:i - 1]]), 0) - 1)::BIGINT AS start, length(ls[i])::BIGINT AS size FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) , range(1, 100000) r(i) WHERE i <= len(ls)""")
def passage_offsets(spark, sf_dir):
    return text.passages(t(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", F.col("n").cast("long").alias("n"), F.col("start").cast("long").alias("start"), (F.col("stop") - F.col("start")).cast("long").alias("size"))


@query("SELECT doc_id, length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::BIGINT AS latin, length(regexp_replace(text, '[^가-힣]', '', 'g'))::BIGINT AS hangul, length(regexp_replace(text, '[^\\p{L}]', '', 'g'))::BIGINT AS letters FROM documents")
def language_stats(spark, sf_dir):
    s = text.letter_stats(F.col("text"))
    return t(spark, sf_dir, "documents").select("doc_id", s["latin"].cast("long").alias("latin"), s["hangul"].cast("long").alias("hangul"), s["letters"].cast("long").alias("letters"))


@query("SELECT p_partkey, concat_ws(',', CASE WHEN regexp_matches(p_name, '(?i)ring|gear') THEN 'PARTS' END, CASE WHEN regexp_matches(p_name, '(?i)^(small|large)\\b') THEN 'SIZED' END) AS families FROM part")
def scope_families(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", F.array_join(text.scope_families(F.col("p_name"), {"PARTS": "ring|gear", "SIZED": r"^(small|large)\b"}), ",").alias("families"))


@query("SELECT doc_id, sha256(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS group_id, min(doc_id) OVER w AS representative, count(*) OVER w AS members FROM documents WINDOW w AS (PARTITION BY sha256(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))))")
def exact_duplicates_group(spark, sf_dir):
    return evaluate.exact_duplicates(t(spark, sf_dir, "documents"), "doc_id", "text")


@query("SELECT doc_id, lang, r AS place FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('seed:' || doc_id), doc_id) AS r FROM documents) WHERE r <= 20")
def stratified_sample(spark, sf_dir):
    return evaluate.stratified_sample(t(spark, sf_dir, "documents", "doc_id", "lang"), "lang", "doc_id", "seed", 20)


@query("""WITH x AS (SELECT n_chars > 1000 AS p, quality = 1 AS a, lang FROM documents LEFT JOIN labels USING (doc_id)),
c AS (SELECT lang, count(*) AS rows, count(*) FILTER (WHERE p AND a) AS true_positive, count(*) FILTER (WHERE p AND NOT a) AS false_positive, count(*) FILTER (WHERE NOT p AND a) AS false_negative, count(*) FILTER (WHERE p IS NULL OR a IS NULL) AS abstained FROM x GROUP BY 1)
SELECT *, round(true_positive / nullif(true_positive + false_positive, 0)::DOUBLE, 6) AS precision, round(true_positive / nullif(true_positive + false_negative, 0)::DOUBLE, 6) AS recall FROM c""")
def eval_precision_recall(spark, sf_dir):
    d = t(spark, sf_dir, "documents", "doc_id", "lang", "n_chars").join(t(spark, sf_dir, "labels"), "doc_id", "left")
    return evaluate.precision_recall(d, F.col("n_chars") > 1000, F.col("quality") == 1, ["lang"])


def _terms(spark, sf_dir):
    """Every distinct word of every text; the id is of the item and the word's place among its distinct words."""
    b = t(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.array_distinct(F.split("text", "\\s+"))).alias("i", "term"))
    return b.where("term <> ''").select((F.col("item_id") * 1_000_000 + F.col("i")).alias("term_id"), "term")


@query("""WITH b AS (SELECT item_id, list_distinct(string_split_regex(text, '\\s+')) AS l, string_split_regex(text, '\\s+') AS w FROM benchmark),
o AS (SELECT item_id, term, min(i) AS i FROM (SELECT item_id, unnest(w) AS term, generate_subscripts(w, 1) AS i FROM b) GROUP BY ALL), x AS (SELECT item_id * 1000000 + row_number() OVER (PARTITION BY item_id ORDER BY i) - 1 AS term_id, term FROM o),
f AS (SELECT doc_id, term FROM documents, (SELECT DISTINCT term FROM x WHERE term <> '') WHERE contains(text, term)) SELECT doc_id, term_id FROM f JOIN x USING (term)""")
def containment_join(spark, sf_dir):
    terms = _terms(spark, sf_dir)
    found = retrieval.containment_join(t(spark, sf_dir, "documents", "doc_id", "text"), terms.select("term").distinct(), "doc_id", "text", "term", "term", gram=4)
    return found.join(terms, "term").select("doc_id", "term_id")


_WORDS = "list_filter(string_split_regex(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"


@query(f"""WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents), s AS (SELECT count(*) AS n, avg(len(w)) AS avg FROM d),
q AS (SELECT DISTINCT item_id, unnest({_WORDS.format('text')}) AS term FROM benchmark), x AS (SELECT doc_id, len(w) AS len, unnest(w) AS term FROM d),
tf AS (SELECT doc_id, len, term, count(*) AS tf FROM x WHERE term IN (SELECT term FROM q) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
sc AS (SELECT item_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg))), 6) AS score FROM q JOIN tf USING (term) JOIN df USING (term), s GROUP BY 1, 2)
SELECT item_id, doc_id, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc) WHERE rank <= 10""")
def bm25_topk(spark, sf_dir):
    r = retrieval.bm25_top_k(t(spark, sf_dir, "documents", "doc_id", "text"), t(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text", 10)
    return r.select("item_id", "doc_id", F.round("score", 4).alias("score"))


_IDF = "CAST(round(CAST(sum({}) AS DECIMAL(28,9)), 3) AS DOUBLE)"


@query(f"""WITH w AS (SELECT DISTINCT item_id, unnest({_WORDS.format('text')}) AS word FROM benchmark), v AS (SELECT * FROM w WHERE length(word) BETWEEN 2 AND 40),
g AS (SELECT item_id, word AS term, 1.0 AS weight FROM v UNION ALL SELECT item_id, unnest([word[i:i + 2] for i in range(1, length(word) - 1)]), 0.65 FROM v WHERE length(word) > 3 UNION ALL SELECT item_id, unnest([word[i:i + 1] for i in range(1, length(word))]), 0.35 FROM v WHERE length(word) > 2),
m AS (SELECT item_id, term, max(weight) AS weight FROM g GROUP BY ALL), t AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY weight DESC, length(term) DESC, term) <= 480),
d AS (SELECT doc_id, lower(coalesce(text, '')) AS body, lower(split_part(coalesce(text, ''), chr(10), 1)) AS name, lower(coalesce(source, '')) AS src FROM documents),
h AS (SELECT term, doc_id, CASE WHEN contains(name, term) THEN 8.0 WHEN contains(src, term) THEN 4.0 ELSE 1.0 END AS loc FROM (SELECT DISTINCT term FROM t), d WHERE contains(body || ' ' || src, term)),
df AS (SELECT term, count(*) AS df FROM h GROUP BY 1), s AS (SELECT item_id, doc_id, {_IDF.format("weight::DOUBLE * loc::DOUBLE * ln(1 + (SELECT count(*) FROM documents) / df::DOUBLE)")} AS score FROM t JOIN h USING (term) JOIN df USING (term) GROUP BY 1, 2)
SELECT item_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 5""")
def ngram_idf_topk(spark, sf_dir):
    # a document's first line stands for the catalogue's name, its source for the occupation, the rest for the definition
    d, b = t(spark, sf_dir, "documents", "doc_id", "text", "source"), t(spark, sf_dir, "benchmark")
    terms = retrieval.query_terms(b, "item_id", "text", {3: 0.65, 2: 0.35}, cap=480)
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    fields = d.select("doc_id", low(F.col("text")).alias("text"), low(F.split_part("text", F.lit("\n"), F.lit(1))).alias("name"), low(F.col("source")).alias("source"))
    whole = fields.withColumn("text", F.concat_ws(" ", "text", "source"))
    return retrieval.containment_top_k(whole, terms, d.count(), "item_id", "doc_id", "text", 5, [("name", 8.0), ("source", 4.0)])


@query("""WITH p AS (SELECT page_id, regexp_extract_all(html, '<li><a [^>]*>([^<]*)</a></li>', 1) AS l, len(regexp_extract_all(html, '<p>')) AS paragraphs FROM pages) SELECT page_id, sha256(array_to_string(l, '|')) AS items, paragraphs FROM p""")
def html_sections(spark, sf_dir):
    d = documents_.html_sections(t(spark, sf_dir, "pages"), "page_id", "html").where("kind IN ('li', 'p')")
    items = F.filter(F.array_sort(F.collect_list(F.struct("n", "kind", "text"))), lambda x: x["kind"] == "li")
    return d.groupBy("page_id").agg(F.sha2(F.array_join(F.transform(items, lambda x: x["text"]), "|"), 256).alias("items"), F.count_if(F.col("kind") == "p").alias("paragraphs"))


# --- graph and rules ---


@query("""SELECT predicate, count(*) AS edges, count(DISTINCT s) AS subjects, count(DISTINCT o) AS objects FROM (
SELECT 'PLACED_BY' AS predicate, o_orderkey AS s, o_custkey AS o FROM orders UNION SELECT 'SUPPLIED_BY', l_orderkey, l_suppkey FROM lineitem UNION SELECT 'IN_NATION', c_custkey, c_nationkey FROM customer) GROUP BY 1""")
def edge_owner_dedupe(spark, sf_dir):
    o, li, c = (t(spark, sf_dir, n) for n in ("orders", "lineitem", "customer"))
    e = graph.edges(o, F.col("o_orderkey"), "PLACED_BY", F.col("o_custkey")).unionByName(graph.edges(li, F.col("l_orderkey"), "SUPPLIED_BY", F.col("l_suppkey"))).unionByName(graph.edges(c, F.col("c_custkey"), "IN_NATION", F.col("c_nationkey")))
    return graph.degree_summary(e)


@query("""SELECT 'nation/' || n_nationkey AS node_id, sha256('nation/' || n_nationkey || chr(10) || '{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}') AS content_hash FROM nation""")
def node_hashes(spark, sf_dir):
    return graph.nodes(t(spark, sf_dir, "nation"), "NATION", F.col("n_nationkey"), ["n_name", "n_regionkey"]).select("node_id", "content_hash")


@query("SELECT DISTINCT c_nationkey::VARCHAR AS subject_id, 'ORDERED' AS predicate, 'S' || o_orderstatus AS object_id FROM orders JOIN customer ON c_custkey = o_custkey")
def flat_graph_collapse(spark, sf_dir):
    e = t(spark, sf_dir, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("subject_id"), F.lit("ORDERED").alias("predicate"), F.concat(F.lit("S"), "o_orderstatus").alias("object_id"))
    e = e.unionByName(e.withColumn("predicate", F.lit("HAS_REVISION")))
    b = t(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("revision_id"), F.col("c_nationkey").cast("string").alias("entity_id"))
    return graph.collapse(e, b)


@query("""SELECT event_id, 'a.k' AS path, 'number' AS kind, json_extract_string(props, '$.k') AS value FROM events UNION ALL SELECT event_id, 'deep' || repeat('.x', (event_id % 9)::INT), 'string', '{' || event_type FROM events
UNION ALL SELECT event_id, 'k~2~0', 'boolean', CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END FROM events UNION ALL SELECT event_id, 'l', 'array', '[' || event_id || ',1]' FROM events UNION ALL SELECT event_id, 'm', 'invalid', '[' || event_id || ',"1"]' FROM events WHERE event_id % 3 = 0""")
def flat_properties(spark, sf_dir):
    deep = F.concat(F.lit('"deep":'), F.repeat(F.lit('{"x":'), (F.col("event_id") % 9).cast("int")), F.lit('"{'), F.col("event_type"), F.lit('"'), F.repeat(F.lit("}"), (F.col("event_id") % 9).cast("int")))
    plain = F.concat(F.lit('"k.~":'), (F.col("event_id") % 2 == 0).cast("string"), F.lit(',"none":null,"l":['), "event_id", F.lit(",1]"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(',"m":['), "event_id", F.lit(',"1"]'))).otherwise(""))
    e = t(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"a":'), "props", F.lit(","), deep, F.lit(","), plain, F.lit("}")).alias("j"))
    return graph.flat_properties(e, "event_id", "j")


@query("""WITH RECURSIVE p AS (SELECT p_partkey AS node, p_partkey // 3 AS parent FROM part WHERE p_partkey > 0), a AS (SELECT node, parent AS ancestor, 1 AS steps FROM p UNION ALL SELECT a.node, p.parent, steps + 1 FROM a JOIN p ON p.node = a.ancestor)
SELECT node, ancestor, steps::BIGINT AS steps FROM a""")
def taxonomy_prefix_tree(spark, sf_dir):
    p = t(spark, sf_dir, "part").where("p_partkey > 0").selectExpr("p_partkey AS child", "p_partkey div 3 AS parent")
    return graph.ancestors(p, "child", "parent").select("node", "ancestor", F.col("steps").cast("long").alias("steps"))


@query("""SELECT p_partkey AS code, 'LEVEL' AS issue FROM part WHERE p_partkey % 50 = 7 UNION ALL SELECT p_partkey, 'NO_PARENT' FROM part WHERE p_partkey % 50 = 9 UNION ALL SELECT p_partkey, 'CYCLE' FROM part WHERE p_partkey IN (3, 4)
UNION ALL SELECT p_partkey, 'LEVEL' FROM part WHERE p_partkey IN (3, 4)""")
def taxonomy_issues(spark, sf_dir):
    p = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("code"))
    items = p.withColumn("level", F.when(F.col("code") == 0, 1).when(F.col("code") % 50 == 7, 3).otherwise(2))
    links = p.where("code > 0 AND code % 50 <> 9").select(F.col("code").alias("child"), F.when(F.col("code") == 3, 4).when(F.col("code") == 4, 3).otherwise(0).cast("long").alias("parent"))
    return graph.taxonomy_issues(items, links)


@query("""SELECT c_custkey, rule_id, state FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal > 0 END AS rich, c_mktsegment = 'BUILDING' AS b FROM customer),
LATERAL (VALUES ('r1', CASE WHEN b THEN 'DISABLED' WHEN rich AND NOT b THEN 'APPLIES' WHEN NOT (rich AND NOT b) THEN 'NOT' ELSE 'UNKNOWN' END), ('r2', CASE WHEN b THEN 'APPLIES' ELSE 'NOT' END)) v(rule_id, state)""")
def guarded_rules(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select("c_custkey", F.create_map(F.lit("rich"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal") > 0), F.lit("b"), F.col("c_mktsegment") == "BUILDING").alias("o"))
    test = lambda n: {"op": "TEST", "name": n}
    return rules.evaluate_rules(c, "c_custkey", "o", [{"id": "r1", "guard": {"op": "AND", "children": [test("rich"), {"op": "NOT", "children": [test("b")]}]}}, {"id": "r2", "action": "DISABLE", "target": "r1", "guard": test("b")}])


@query("""SELECT item_id, issue FROM (SELECT item_id, string_split(text, ' ') AS w FROM benchmark), LATERAL (VALUES (CASE WHEN item_id % 4 = 0 THEN 'TOO_MANY_MATCHES' END), (CASE WHEN item_id % 4 = 1 THEN 'REPEATED_CODE' END), (CASE WHEN item_id % 5 = 0 THEN 'QUOTE_NOT_IN_SOURCE' END)) v(issue) WHERE issue IS NOT NULL""")
def citation_validator(spark, sf_dir):
    b = t(spark, sf_dir, "benchmark")
    codes = F.when(F.col("item_id") % 4 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).when(F.col("item_id") % 4 == 1, F.array(F.lit("a"), F.lit("a"))).otherwise(F.array(F.lit("b")))
    quotes = F.array(F.when(F.col("item_id") % 5 == 0, "not there ☃").otherwise(F.split_part("text", F.lit(" "), F.lit(1))))
    return rules.citation_issues(b.select("item_id", codes.alias("codes"), F.array(F.lit("a"), F.lit("b"), F.lit("c")).alias("shortlist"), quotes.alias("quotes"), F.col("text").alias("source")), "item_id")


@query("""WITH s AS (SELECT l_orderkey AS k, l_linenumber::BIGINT AS id, l_partkey % 100 AS a, l_partkey % 100 + 10 AS b FROM lineitem)
SELECT k, id FROM (SELECT k, id, a, max(b) OVER (PARTITION BY k ORDER BY a, b, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS u FROM s) WHERE a < u""")
def overlapping_passages(spark, sf_dir):
    s = t(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS k", "CAST(l_linenumber AS bigint) AS id", "l_partkey % 100 AS a", "l_partkey % 100 + 10 AS b")
    return rules.overlapping_spans(s, "k", "id", "a", "b")


@query("SELECT p_brand AS code, y::BIGINT AS year, 'year-' || y || '-item-' || p_brand AS partition_id FROM (SELECT DISTINCT p_brand FROM part), range(2020, 2024) r(y)")
def expected_partitions(spark, sf_dir):
    d = readers.expected_partitions(t(spark, sf_dir, "part", F.col("p_brand").alias("code")), "code", 2020, 2023)
    return d.withColumn("year", F.col("year").cast("long"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'INVALID_JSON' ELSE 'NOT_AN_OBJECT' END AS error_code FROM events WHERE event_id % 3 = 0 OR event_id % 7 = 0")
def json_row_rejects(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, '{"a":1,"a":2}').when(F.col("event_id") % 7 == 0, "[1]").otherwise(F.col("props")).alias("body"))
    return readers.json_rows(e, "body")[1].select("event_id", "error_code")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate::DATE AS VARCHAR) END AS day, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate::DATE + INTERVAL 1 DAY - INTERVAL 9 HOUR AS VARCHAR) END AS deadline_utc FROM orders")
def day_deadline(spark, sf_dir):
    raw = F.when(F.col("o_orderkey") % 4 == 0, "20260230").otherwise(F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(" ")))
    d = t(spark, sf_dir, "orders").select("o_orderkey", text.day(raw).alias("d"))
    return d.select("o_orderkey", F.col("d").cast("string").alias("day"), F.date_format(temporal.deadline(F.col("d")), "yyyy-MM-dd HH:mm:ss").alias("deadline_utc"))


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'DAY' WHEN 1 THEN 'DAY' WHEN 2 THEN 'INSTANT' WHEN 3 THEN 'INSTANT' END AS kind, CASE WHEN o_orderkey % 8 < 2 THEN CAST(o_orderdate::DATE AS VARCHAR) END AS day,
CASE WHEN o_orderkey % 8 = 2 THEN strftime(o_orderdate::DATE, '%Y-%m-%d 00:00:00') WHEN o_orderkey % 8 = 3 THEN strftime(o_orderdate::DATE + INTERVAL 1 HOUR + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') END AS instant FROM orders WHERE o_orderkey % 8 < 4
UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 7 THEN NULL ELSE 'INVALID' END, NULL, NULL FROM orders WHERE o_orderkey % 8 >= 4""")
def date_kinds(spark, sf_dir):
    day, n = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 8
    raw = F.when(n == 0, day).when(n == 1, F.concat(day, F.lit("T00:00:00.000Z"))).when(n == 2, F.concat(day, F.lit("T00:00:00+00:00"))).when(n == 3, F.concat(day, F.lit("T10:30:00+09:00"))).when(n == 4, F.concat(F.substring(day, 1, 8), F.lit("32"))).when(n == 5, F.substring(day, 1, 4)).when(n == 6, F.concat(day, F.lit(" 10:00:00")))
    o = t(spark, sf_dir, "orders").select("o_orderkey", raw.alias("r"))
    return o.select("o_orderkey", temporal.date_kind(F.col("r")).alias("kind"), temporal.stated_day(F.col("r")).cast("string").alias("day"), F.date_format(temporal.stated_instant(F.col("r")), "yyyy-MM-dd HH:mm:ss").alias("instant"))


@query("""WITH o AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS a, CASE c_custkey // 3 % 3 WHEN 0 THEN true WHEN 1 THEN false END AS b, CASE c_custkey // 9 % 3 WHEN 0 THEN true WHEN 1 THEN false END AS c FROM customer),
r AS (SELECT c_custkey, c AS r3, b AND NOT c AS r2, a AS r4 FROM o), q AS (SELECT *, true AND NOT r2 AND NOT r4 AS r1 FROM r),
v AS (SELECT c_custkey, unnest(['r1', 'r2', 'r3', 'r4']) AS rule_id, unnest([r1, r2, r3, r4]) AS active, unnest([coalesce(r2 OR r4, false), coalesce(r3, false), false, false]) AS off FROM q)
SELECT c_custkey, rule_id, CASE WHEN off THEN 'DISABLED' WHEN active THEN 'APPLIES' WHEN NOT active THEN 'NOT' ELSE 'UNKNOWN' END AS state FROM v""")
def chained_rules(spark, sf_dir):
    at = lambda d: F.when(F.floor(F.col("c_custkey") / d) % 3 == 0, True).when(F.floor(F.col("c_custkey") / d) % 3 == 1, False)
    c = t(spark, sf_dir, "customer").select("c_custkey", F.create_map(F.lit("a"), at(1), F.lit("b"), at(3), F.lit("c"), at(9)).alias("o"))
    off = lambda i, target, name: {"id": i, "action": "DISABLE", "target": target, "guard": {"op": "TEST", "name": name}}
    return rules.evaluate_rules(c, "c_custkey", "o", [{"id": "r1"}, off("r2", "r1", "b"), off("r3", "r2", "c"), off("r4", "r1", "a")])


@query("""SELECT o_custkey AS k, count(DISTINCT o_orderstatus) AS contents FROM orders WHERE o_orderkey % 5 < 2 GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1""")
def batch_conflict_keys(spark, sf_dir):
    o = t(spark, sf_dir, "orders").where("o_orderkey % 5 < 2").select(F.col("o_custkey").alias("k"), "o_orderstatus")
    return ledger.batch_conflicts(o, ["k"], "o_orderstatus")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE c_custkey * 7 END AS n FROM customer")
def digits_of_any_script(spark, sf_dir):
    k = (F.col("c_custkey") * 7).cast("string")
    raw = F.when(F.col("c_custkey") % 4 == 0, k).when(F.col("c_custkey") % 4 == 1, F.translate(k, "0123456789", "٠١٢٣٤٥٦٧٨٩")).when(F.col("c_custkey") % 4 == 2, F.concat(F.lit("\u3000"), F.translate(k, "0123456789", "０１２３４５６７８９"))).otherwise(F.concat(k, F.lit("x")))
    return t(spark, sf_dir, "customer").select("c_custkey", text.source_integer(raw).alias("n"))
