"""Ledger validation, citations, accounting, common postings, reports, attachments and shapes over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import claims, cohort, graph, ledger_checks
from ..sources import bundles, documents, readers
from .registry import query, t


def _s(c):
    return F.col(c).cast("string")


# --- ledger ---

# Customers are runs of two sources, orders their documents, line items their records; remainders break the rules.


def _ledger(spark, sf_dir):
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    c = t(spark, sf_dir, "customer")
    src = F.when(k % 2 == 0, "paged").otherwise("pairs")
    runs = c.select(k.alias("run_id"), src.alias("source_id"), F.when(k % 31 == 0, "SMOKE").otherwise("FULL").alias("mode"), F.lit("READY").alias("state"))
    up = c.where("c_custkey % 2 = 1 AND c_custkey % 17 <> 0").select(k.alias("run_id"), F.lit("paged").alias("input_source_id"), (F.floor(k / 2) * 2 - F.when(k % 19 == 0, 1).otherwise(0)).alias("input_run_id"))
    own = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id"), o, _s("o_orderkey").alias("document_id")).where("run_id % 2 = 0")
    n = own.groupBy("run_id").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    no = F.row_number().over(Window.partitionBy("run_id").orderBy("o_orderkey"))
    docs = own.withColumn("page_no", no).join(n, "run_id")
    items = F.least(F.lit(10), F.col("n") * 10 - 3 - (F.col("page_no") - 1) * 10)
    d = docs.select(
        "run_id", "document_id", F.lit("main").alias("partition_id"), F.when(o % 23 == 0, F.col("page_no") + 1).otherwise(F.col("page_no")).alias("page_no"), F.lit(0).alias("confirmation_no"), F.lit("HTTP").alias("transport"), F.when(o % 29 == 0, 500).otherwise(200).alias("http_status"),
        F.when(o % 37 == 0, "99").otherwise("00").alias("provider_result"), F.lit(5).alias("byte_length"), (o % 41 != 0).alias("verified"), items.alias("item_count"), F.when(o % 23 == 0, F.col("page_no") + 1).otherwise(F.col("page_no")).alias("effective_page"), F.lit(10).alias("effective_page_size"), (F.col("n") * 10 - 3).alias("declared_total"), F.lit(True).alias("selected"),
    )
    parts = n.select("run_id", F.lit("main").alias("partition_id"), F.lit("PAGED").alias("kind"), F.lit(10).alias("page_size"), (F.col("n") * 10 - 3).alias("expected_total"))
    rows = docs.withColumn("items", items).select("run_id", "document_id", "o_orderkey", F.explode(F.sequence(F.lit(1), F.greatest(F.col("items"), F.lit(1)))).alias("i"), "items").where("i <= items")
    bad = (F.col("o_orderkey") * 10 + F.col("i")) % 211 == 0
    rec = rows.where(~bad).select("run_id", "document_id", F.concat(F.lit("line:"), "i").alias("locator"), F.when((o % 43 == 0) & (F.col("i") == 2), F.concat("document_id", F.lit("-1"))).otherwise(F.concat_ws("-", "document_id", "i")).alias("source_record_id"), F.when((o % 47 == 0) & (F.col("i") == 1), "Other").otherwise("Unit").alias("kind"), F.create_map(F.lit("part"), F.when((o % 53 == 0) & (F.col("i") == 3), "elsewhere").otherwise("main")).alias("facts"))
    rej = rows.where(bad & (o % 3 != 0)).select("run_id", "document_id", F.concat(F.lit("line:"), "i").alias("locator"))
    pk = c.where("c_custkey % 2 = 1").select(k.alias("run_id"))
    forms = pk.select("run_id", F.explode(F.array(F.lit("list"), F.lit("detail"))).alias("form")).where("NOT (run_id % 13 = 0 AND form = 'detail')")
    part2 = F.when(F.col("form") == "list", "index").otherwise(F.concat(F.lit("detail-"), "run_id"))
    d2 = forms.select("run_id", F.concat_ws("-", "form", "run_id").alias("document_id"), part2.alias("partition_id"), F.lit(1).alias("page_no"), F.lit(0).alias("confirmation_no"), F.lit("LOCAL_FILE").alias("transport"), F.lit(None).cast("int").alias("http_status"), F.lit(None).cast("string").alias("provider_result"), F.lit(5).alias("byte_length"), F.lit(True).alias("verified"), F.lit(1).alias("item_count"), F.lit(1).alias("effective_page"), F.lit(1).alias("effective_page_size"), F.lit(1).alias("declared_total"), F.lit(True).alias("selected"))
    p2 = forms.select("run_id", part2.alias("partition_id"), F.lit("DETAIL").alias("kind"), F.lit(1).alias("page_size"), F.lit(1).alias("expected_total"))
    title = F.when((F.col("run_id") % 11 == 0) & (F.col("form") == "detail"), "other").otherwise("title")
    r2 = forms.select("run_id", F.concat_ws("-", "form", "run_id").alias("document_id"), F.lit("line:1").alias("locator"), F.concat_ws(":", "run_id", "form").alias("source_record_id"), F.lit("Posting").alias("kind"), F.create_map(F.lit("posting_id"), _s("run_id"), F.lit("representation"), F.col("form"), F.lit("title"), title, F.lit("ongoing"), F.when((F.col("run_id") % 3 == 0) | (F.col("form") == "list"), "true").otherwise("")).alias("facts"))
    rules = {
        "paged": ledger_checks.Rules(kind="Unit", results=("00", "0"), partition=lambda f: F.try_element_at(f, F.lit("part"))),
        "pairs": ledger_checks.Rules(depends_on="paged", kind="Posting", partition=lambda f: F.when(F.try_element_at(f, F.lit("representation")) == "list", "index").otherwise(F.concat(F.lit("detail-"), F.try_element_at(f, F.lit("posting_id")))), forms=("list", "detail"), pair_facts=("title",), soft_facts=("ongoing",)),
    }
    return {"runs": runs, "dependencies": up, "partitions": parts.unionByName(p2), "documents": d.unionByName(d2), "records": rec.unionByName(r2), "rejected": rej}, rules


@query("""WITH c AS (SELECT c_custkey AS k FROM customer), o AS (SELECT o_custkey AS r, o_orderkey AS o, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WHERE o_custkey % 2 = 0), d AS (SELECT *, least(10, n * 10 - 3 - (p - 1) * 10) AS items, CASE WHEN o % 23 = 0 THEN p + 1 ELSE p END AS page FROM o),
x AS (SELECT r, o, items, unnest(range(1, items + 1)) AS i FROM d), y AS (SELECT *, (o * 10 + i) % 211 = 0 AS bad FROM x), rec AS (SELECT *, CASE WHEN o % 43 = 0 AND i = 2 THEN o || '-1' ELSE o || '-' || i END AS sid FROM y WHERE NOT bad), rej AS (SELECT * FROM y WHERE bad AND o % 3 <> 0), cnt AS (SELECT o, count(*) AS n FROM (SELECT o FROM rec UNION ALL SELECT o FROM rej) GROUP BY 1),
pg AS (SELECT r, n, min(page) AS lo, max(page) AS hi FROM d GROUP BY ALL)
SELECT k AS run_id, 'SMOKE_NOT_FULL' AS issue, '' AS location FROM c WHERE k % 31 = 0 UNION ALL SELECT k, 'NO_PARTITIONS', '' FROM c WHERE k % 2 = 0 AND k NOT IN (SELECT r FROM o)
UNION ALL SELECT k, 'DEPENDENCY_NOT_READY_OR_WRONG_SOURCE', 'paged' FROM (SELECT k, k // 2 * 2 - (k % 19 = 0)::INT AS u FROM c WHERE k % 2 = 1 AND k % 17 <> 0) WHERE u IN (SELECT k FROM c) AND (u % 2 = 1 OR u % 31 = 0) UNION ALL SELECT k, 'MISSING_DEPENDENCY', 'pairs' FROM c WHERE k % 2 = 1 AND k % 17 = 0
UNION ALL SELECT r, 'PARTITION_INCOMPLETE', 'main' FROM pg WHERE lo <> 1 OR hi <> n UNION ALL SELECT r, 'DOCUMENT_NOT_VERIFIED', o::VARCHAR FROM d WHERE o % 29 = 0 OR o % 37 = 0 OR o % 41 = 0 OR items <> greatest(0, least(10, n * 10 - 3 - (page - 1) * 10)) UNION ALL SELECT r, 'ROW_COUNT_MISMATCH', d.o::VARCHAR FROM d LEFT JOIN cnt USING (o) WHERE items <> coalesce(cnt.n, 0)
UNION ALL SELECT r, 'REJECTED_ROW', o || ':line:' || i FROM rej UNION ALL SELECT r, 'DUPLICATE_SOURCE_ID', sid FROM rec GROUP BY r, sid HAVING count(*) > 1 UNION ALL SELECT r, 'WRONG_RECORD_KIND', o || ':line:' || i FROM rec WHERE o % 47 = 0 AND i = 1 UNION ALL SELECT r, 'PARTITION_IDENTITY_MISMATCH', o || ':line:' || i FROM rec WHERE o % 53 = 0 AND i = 3
UNION ALL SELECT k, 'POSTING_FORMS_MISSING_OR_REPEATED', k::VARCHAR FROM c WHERE k % 2 = 1 AND k % 13 = 0 UNION ALL SELECT k, 'POSTING_PAIR_CONFLICT', k::VARCHAR FROM c WHERE k % 2 = 1 AND k % 13 <> 0 AND k % 11 = 0""")
def ledger_validation(spark, sf_dir):
    return ledger_checks.issues(*_ledger(spark, sf_dir))


@query("""WITH r AS (SELECT o_custkey AS s, o_orderkey AS k, o_orderdate AS d, o_orderstatus AS c, o_orderpriority AS n FROM orders), x AS (SELECT *, row_number() OVER w AS i, lag(c) OVER w AS pc, lag(n) OVER w AS pn FROM r WINDOW w AS (PARTITION BY s ORDER BY d, k)) SELECT k AS run_id, CASE WHEN i = 1 THEN 'FIRST' WHEN pc <> c THEN 'CHANGED' WHEN pn <> n THEN 'PARSED_ANEW' ELSE 'SAME' END AS change FROM x""")
def changed_runs(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    return ledger_checks.changed_runs(o.select(F.col("o_custkey").alias("source_id"), F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("created_at"), F.col("o_orderstatus").alias("content_hash"), F.col("o_orderpriority").alias("normalized_hash")))


@query("""WITH l AS (SELECT user_id AS s, arg_max(event_id, (ts, event_id)) AS r, max(ts) AS d FROM events WHERE event_type = 'view' GROUP BY 1), f AS (SELECT user_id AS s, max(ts) AS at_, count(*) AS n FROM events LEFT JOIN l ON l.s = user_id WHERE event_type = 'error' AND (l.s IS NULL OR ts > l.d) GROUP BY 1), u AS (SELECT user_id AS s, (user_id + 1) AS i FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 4 = 0),
x AS (SELECT s.user_id AS s, l.r, l.d, f.at_, f.n, ul.d AS ud, u.i IS NOT NULL AND ul.s IS NULL AS lacking FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 7 <> 0) s LEFT JOIN l ON l.s = s.user_id LEFT JOIN f ON f.s = s.user_id LEFT JOIN u ON u.s = s.user_id LEFT JOIN l ul ON ul.s = u.i)
SELECT s AS source_id, CASE WHEN r IS NULL THEN 'NEVER' WHEN floor(epoch(TIMESTAMP '2024-01-31') - epoch(date_trunc('second', d))) > 40000 THEN 'INTERVAL' WHEN r % 3 <> 0 THEN 'NOT_EXPORTED' WHEN ud > d THEN 'UPSTREAM_NEWER' END AS reason FROM x WHERE reason IS NOT NULL AND NOT lacking AND NOT coalesce(floor(epoch(TIMESTAMP '2024-01-31') - epoch(date_trunc('second', at_))) < least(3600 * 2 ** least(n - 1, 20), 86400), false)""")
def refresh_order(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumnRenamed("user_id", "source_id")
    s = e.select("source_id").distinct().select("source_id", (F.col("source_id") % 7 != 0).alias("enabled"), F.lit(40000).alias("interval_seconds"), F.lit(3600).alias("retry_seconds"), F.lit(86400).alias("most_seconds"))
    runs = e.where("event_type = 'view'").select("source_id", F.col("event_id").alias("run_id"), F.col("ts").alias("created_at"))
    return ledger_checks.refresh_order(s, runs, e.where("event_type = 'error'").select("source_id", F.col("ts").alias("failed_at")), runs.where("run_id % 3 = 0").select("run_id"), s.where("source_id % 4 = 0").select("source_id", (F.col("source_id") + 1).alias("input_source_id")), "2024-01-31 00:00:00")


@query("""SELECT event_type AS source_id, arg_max(event_id, (ts, event_id)) AS latest, arg_max(CASE WHEN value < 5 THEN 'FAILED' ELSE 'READY' END, (ts, event_id)) AS latest_state, arg_max(event_id, (ts, event_id)) FILTER (WHERE value >= 5) AS accepted, count(*) AS runs, count(*) FILTER (WHERE value < 5 AND floor(epoch(TIMESTAMP '2024-01-25') - epoch(date_trunc('second', ts))) < 86400) AS failures FROM events GROUP BY 1""")
def source_telemetry(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(F.col("event_type").alias("source_id"), F.col("event_id").alias("run_id"), F.col("ts").alias("created_at"), F.when(F.col("value") < 5, "FAILED").otherwise("READY").alias("state"))
    return ledger_checks.source_telemetry(e, "2024-01-25 00:00:00")


@query("""SELECT 'label' AS part, c_mktsegment AS name, count(*) AS n FROM customer GROUP BY 2 UNION ALL SELECT 'label', 'Customer', count(*) FROM customer UNION ALL SELECT 'predicate', o_orderstatus, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'total', 'nodes', count(*) FROM customer UNION ALL SELECT 'total', 'edges', count(*) FROM orders""")
def graph_telemetry(spark, sf_dir):
    return ledger_checks.graph_telemetry(t(spark, sf_dir, "customer").select(F.array(F.lit("Customer"), F.col("c_mktsegment")).alias("labels")), t(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("predicate")))


# --- answers and claims ---


@query("""SELECT p_partkey AS k, unnest(list_filter([CASE WHEN p_partkey % 5 = 0 THEN 'TOO_MANY_MATCHES' END, CASE WHEN p_partkey % 5 IN (0, 1) THEN 'REPEATED_CODE' END, CASE WHEN p_partkey % 5 = 2 THEN 'OUTSIDE_SHORTLIST' END, CASE WHEN p_partkey % 5 = 3 THEN 'QUOTE_COUNT' END, CASE WHEN p_partkey % 7 = 0 AND p_partkey % 5 <> 3 THEN 'QUOTE_NOT_IN_FIELD' END], lambda x: x IS NOT NULL)) AS issue FROM part""")
def match_citations(spark, sf_dir):
    k = F.col("p_partkey")
    quote = F.struct(F.lit("name").alias("field"), F.when(k % 7 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.substring("p_name", 2, 3)).alias("quote"))
    quotes = F.when(k % 5 == 3, F.array().cast("array<struct<field:string,quote:string>>")).otherwise(F.array(quote))
    codes = F.when(k % 5 == 0, F.array(*map(F.lit, "aab"))).when(k % 5 == 1, F.array(*map(F.lit, "aa"))).when(k % 5 == 2, F.array(F.lit("z"))).otherwise(F.array(*map(F.lit, "ab")))
    d = t(spark, sf_dir, "part").withColumn("_q", quotes).select(k.alias("k"), F.transform(codes, lambda c: F.struct(c.alias("code"), F.col("_q").alias("quotes"))).alias("matches"), F.array(*map(F.lit, "abc")).alias("shortlist"), F.create_map(F.lit("name"), F.col("p_name")).alias("fields"))
    return claims.match_issues(d, "k")


@query("""SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 1 THEN 'ANCHORS_NOT_IN_ORDER' WHEN 2 THEN 'ALTERNATIVE_BETWEEN_ANCHORS' ELSE 'ANCHORS_NOT_IN_ORDER' END AS issue FROM part WHERE p_partkey % 4 IN (1, 2, 3)""")
def role_anchors(spark, sf_dir):
    k = F.col("p_partkey")
    body = F.when(k % 4 == 2, F.concat_ws(" or ", F.lit("cook"), F.lit("waiter"))).otherwise(F.concat_ws(" and ", F.lit("cook"), F.lit("waiter")))
    anchors = F.when(k % 4 == 1, F.array(F.lit("waiter"), F.lit("cook"))).when(k % 4 == 3, F.array(F.lit("cook and"), F.lit("and waiter"))).otherwise(F.array(F.lit("cook"), F.lit("waiter")))
    return claims.anchor_issues(t(spark, sf_dir, "part").select(k.alias("k"), body.alias("text"), anchors.alias("anchors")), "k")


@query("""SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 1 THEN 'RANKS' WHEN 2 THEN 'QUOTE_COUNT' WHEN 3 THEN 'QUOTE_LENGTH' ELSE 'QUOTE_NOT_FOUND' END AS issue FROM part WHERE p_partkey % 5 <> 0""")
def ranked_quotes(spark, sf_dir):
    k = F.col("p_partkey")
    q = F.when(k % 5 == 2, F.array().cast("array<string>")).when(k % 5 == 3, F.array(F.substring("p_name", 1, 1))).when(k % 5 == 4, F.array(F.lit("zzz"))).otherwise(F.array(F.substring("p_name", 1, 3)))
    items = F.array(F.struct(F.lit(1).alias("rank"), q.alias("quotes")), F.struct(F.when(k % 5 == 1, 3).otherwise(2).alias("rank"), F.array(F.col("p_type")).alias("quotes")))
    return claims.ranked_quote_issues(t(spark, sf_dir, "part").select(k.alias("k"), items.alias("items"), F.array("p_name", "p_type").alias("leaves")), "k")


@query("""WITH p AS (SELECT l_orderkey AS k, l_linenumber AS n, bool_or(l_returnflag <> 'N') AS narrative, bool_or(l_suppkey % 3 = 0) AS cited, count(*) FILTER (WHERE l_suppkey % 4 = 0) AS said FROM lineitem GROUP BY ALL), x AS (SELECT k, n, list_filter([CASE WHEN said > 1 THEN 'DUPLICATE_DISPOSITION' END, CASE WHEN cited AND said > 0 THEN 'CONFLICTING_DISPOSITION' END, CASE WHEN narrative AND NOT cited AND said = 0 THEN 'UNACCOUNTED_PASSAGE' END], lambda x: x IS NOT NULL) AS issues FROM p)
SELECT k, n, unnest(issues) AS issue FROM x UNION ALL SELECT o_orderkey, 99, 'UNKNOWN_PASSAGE' FROM orders WHERE o_orderkey % 100 = 0""")
def passage_accounting(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), "l_returnflag", "l_suppkey")
    p = li.groupBy("k", "n").agg(F.bool_or(F.col("l_returnflag") != "N").alias("narrative"))
    extra = t(spark, sf_dir, "orders").where("o_orderkey % 100 = 0").select(F.col("o_orderkey").alias("k"), F.lit(99).alias("n"))
    return claims.passage_accounting(p, li.where("l_suppkey % 3 = 0").select("k", "n").unionByName(extra), li.where("l_suppkey % 4 = 0").select("k", "n", F.lit("x").alias("kind")), "k")


@query("""SELECT p_partkey AS k, 'UNSUPPORTED_FRAGMENT' AS issue FROM part WHERE p_partkey % 3 <> 0""")
def unsupported_fragments(spark, sf_dir):
    k = F.col("p_partkey")
    f = F.when(k % 3 == 0, F.array(F.regexp_replace("p_name", " ", "\n  "))).when(k % 3 == 1, F.array(F.col("p_name"), F.lit("none"))).otherwise(F.array().cast("array<string>"))
    return claims.fragment_issues(t(spark, sf_dir, "part").select(k.alias("k"), f.alias("fragments"), F.array(F.concat(F.lit("x  "), "p_name")).alias("quotes")), "k")


@query("""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, ls, CASE WHEN doc_id % 3 = 0 THEN 'not there ☃' ELSE split_part(ls[1], ' ', 2) || ' ' || split_part(ls[1], ' ', 3) END AS quote FROM l)
SELECT doc_id, CASE WHEN strpos(ls[1], quote) > 0 THEN strpos(ls[1], quote) - 1 END AS start, CASE WHEN strpos(ls[1], quote) > 0 THEN strpos(ls[1], quote) - 1 + length(quote) END AS stop FROM c WHERE split_part(ls[1], ' ', 3) <> '' AND NOT contains(ls[1], '  ')""")
def evidence_in_lines(spark, sf_dir):
    d = t(spark, sf_dir, "documents", "doc_id", "text").where("text IS NOT NULL")
    lines = text.passages(d, "doc_id", "text").select("doc_id", "n", "start", F.col("passage").alias("text"))
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    quote = F.when(F.col("doc_id") % 3 == 0, "not there ☃").otherwise(F.concat_ws(" ", F.split_part(first, F.lit(" "), F.lit(2)), F.split_part(first, F.lit(" "), F.lit(3))))
    c = d.where(~F.contains(first, F.lit("  "))).select("doc_id", F.lit(1).alias("claim"), F.lit(0).alias("first_line"), F.lit(0).alias("last_line"), quote.alias("quote"), F.split_part(first, F.lit(" "), F.lit(3)).alias("third")).where("third <> ''").drop("third")
    return claims.evidence_in_lines(c, lines, "doc_id").select("doc_id", "start", "stop")


@query("""SELECT 'orders' AS source_id, o_orderkey::VARCHAR AS posting_key, o_orderpriority AS title, o_orderdate::DATE::VARCHAR AS first_day FROM orders UNION ALL SELECT 'parts', p_partkey::VARCHAR, p_name, NULL FROM part""")
def common_postings(spark, sf_dir):
    d = claims.common_postings({"orders": (t(spark, sf_dir, "orders"), {"posting_key": F.col("o_orderkey"), "title": F.col("o_orderpriority"), "first_day": F.col("o_orderdate")}), "parts": (t(spark, sf_dir, "part"), {"posting_key": F.col("p_partkey"), "title": F.col("p_name")})})
    return d.select("source_id", "posting_key", "title", _s("first_day").alias("first_day"))


_CONTEXT = """x AS (SELECT o_orderstatus AS s, o_custkey AS k, o_orderpriority AS occ, CASE WHEN c_custkey IS NULL OR c_custkey % 5 = 0 THEN 'STALE' WHEN o_orderkey % 7 = 0 THEN 'UNKNOWN' WHEN o_orderkey % 11 = 0 THEN 'STALE' ELSE 'CURRENT' END AS f FROM orders LEFT JOIN customer ON c_custkey = o_custkey)"""


@query(f"""WITH {_CONTEXT}, u AS (SELECT 'source' AS part, s AS name, s, k FROM x UNION ALL SELECT 'occupation', occ, s, k FROM x UNION ALL SELECT 'freshness', f, s, k FROM x) SELECT part, name, count(DISTINCT (s, k)) AS postings, count(*) AS associations FROM u GROUP BY ALL""")
def inferred_context(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    i = o.select(F.col("o_orderkey").alias("association_id"), F.col("o_orderstatus").alias("source_id"), F.col("o_custkey").alias("posting_key"), F.col("o_orderpriority").alias("occupation"), F.when(F.col("o_orderkey") % 7 == 0, None).when(F.col("o_orderkey") % 11 == 0, "old").otherwise("now").alias("source_hash"), F.lit("c").alias("catalog_hash"))
    seen = t(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("posting_key"), F.explode(F.array(*map(F.lit, "FOP"))).alias("source_id"), F.lit("now").alias("facts_hash"))
    return claims.context_summary(claims.inferred_context(i, seen, F.lit("c")))


@query("""SELECT p_brand AS role, l_suppkey AS competency, count(DISTINCT l_orderkey) AS postings, count(*) AS links, max(s_nationkey) AS level, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS products FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2""")
def product_roles(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").select(F.monotonically_increasing_id().alias("posting"), "l_orderkey", F.col("l_suppkey").alias("competency"), F.col("l_partkey").alias("product"))
    roles = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("product"), F.col("p_brand").alias("role"), "p_type")
    links = li.select(F.col("l_orderkey").alias("posting"), "competency", "product").join(roles.select("product", "p_type", "role"), "product").select("posting", "competency", F.struct("p_type", "role").alias("product"))
    # a posting and a product stand for an order's part types and brands
    own = links.select("posting", "competency", "product")
    d = own.withColumn("key", F.struct("posting", "product")).select(F.col("key").alias("posting"), "competency")
    p = own.select(F.struct("posting", "product").alias("posting"), F.col("product").alias("product")).distinct()
    r = own.select("product").distinct().select("product", F.col("product.role").alias("role"))
    out = claims.product_roles(d, p, r, t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("competency"), F.col("s_nationkey").alias("level")))
    n = own.select(F.col("product.role").alias("role"), "competency", "posting").groupBy("role", "competency").agg(F.count_distinct("posting").alias("postings"))
    return out.drop("postings").join(n, ["role", "competency"]).select("role", "competency", "postings", "links", "level", F.array_join(F.array_sort(F.array_distinct(F.transform("products", lambda x: x["p_type"]))), "|").alias("products"))


@query("""WITH l AS (SELECT p_brand AS code, l_orderkey AS p, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS r FROM lineitem JOIN part ON p_partkey = l_partkey), h AS (SELECT code, string_agg(k || '=' || n, ',' ORDER BY k) AS reviewers FROM (SELECT code, coalesce(r, 'NONE') AS k, count(*) AS n FROM l GROUP BY ALL) GROUP BY 1), q AS (SELECT p_brand AS code, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS q FROM part WHERE p_size > 48 GROUP BY 1)
SELECT code, count(DISTINCT p) AS postings, count(*) AS links, any_value(reviewers) AS reviewers, coalesce(any_value(q), '') AS qualifications FROM l JOIN h USING (code) LEFT JOIN q USING (code) GROUP BY 1""")
def demand_report(spark, sf_dir):
    part = t(spark, sf_dir, "part")
    li = t(spark, sf_dir, "lineitem").join(part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("code")), "l_partkey").select("code", F.col("l_orderkey").alias("posting"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("reviewer_kind"))
    d = claims.demand_report(li, "code", "posting", part.where("p_size > 48").select(F.col("p_brand").alias("code"), F.col("p_type").alias("name")))
    return d.select("code", "postings", "links", F.array_join(F.transform(F.map_entries("reviewers"), lambda x: F.concat_ws("=", x["key"], x["value"])), ",").alias("reviewers"), F.array_join("qualifications", ",").alias("qualifications"))


@query("""WITH r AS (SELECT o_custkey AS k, arg_max(o_orderstatus, o_orderkey) AS d, arg_max(o_orderkey % 3, o_orderkey) AS m FROM orders WHERE o_orderkey % 10 <> o_custkey % 10 GROUP BY 1) SELECT c_custkey AS item, CASE WHEN d = 'F' AND m = 0 THEN 'ACCEPTED' WHEN d = 'P' THEN 'REJECTED' ELSE 'PENDING' END AS status, c_custkey % 4 <> 0 AS pinned FROM customer LEFT JOIN r ON k = c_custkey""")
def resolved_catalogue(spark, sf_dir):
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    c = t(spark, sf_dir, "customer")
    items = c.select(k.alias("item"), F.col("c_name").alias("content"), (k % 10).alias("actor"))
    computed = c.where("c_custkey % 8 <> 0").select(k.alias("item"), F.when(k % 4 == 0, "changed").otherwise(F.col("c_name")).alias("content"))
    reviews = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("item"), o.alias("review_no"), F.when(F.col("o_orderstatus") == "F", "ACCEPT").when(F.col("o_orderstatus") == "P", "REJECT").otherwise("NOTE").alias("decision"), (o % 10).alias("reviewer"), F.when(o % 3 == 1, "MODEL").otherwise("HUMAN").alias("reviewer_kind"), F.when(o % 3 == 2, "abc").otherwise(F.sha1(_s("o_orderkey"))).alias("commit"), F.lit("m").alias("merge_reference"))
    return claims.resolved_catalogue(items, reviews, computed)


@query("""SELECT p_partkey, sha1('blob ' || octet_length(encode(p_name)) || chr(0) || p_name) AS blob FROM part""")
def blob_ids(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", claims.blob_id(F.encode("p_name", "UTF-8")).alias("blob"))


@query("""SELECT event_id, unnest(['', '/a~1b', '/a~1b/0', '/a~1b/1', '/a~1b/1/k', '/n']) AS pointer, unnest(['object', 'array', 'boolean', 'object', 'number', 'null']) AS kind, unnest([NULL, NULL, 'true', NULL, json_extract_string(props, '$.k'), NULL]) AS value FROM events""")
def json_walk(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"a/b":[true,'), "props", F.lit('],"n":null}')).alias("j"))
    return claims.json_walk(e, "event_id", "j").select("event_id", "pointer", "kind", "value")


@query("""WITH f AS (SELECT l_orderkey AS p, l_linenumber AS n, l_suppkey AS b, l_partkey AS h, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey DESC) AS r FROM (SELECT * FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber, l_suppkey) = 1)), g AS (SELECT p_partkey AS h, max(p_size) AS pid FROM part WHERE p_size % 3 = 0 GROUP BY 1)
SELECT CASE WHEN r > 1 THEN 'SUPERSEDED' WHEN b % 9 = 0 THEN 'WRONG_ROLE' WHEN b % 9 = 1 THEN 'UNSUPPORTED_FORMAT' WHEN b % 9 = 2 THEN 'NOT_ARCHIVED' WHEN b % 9 = 3 THEN 'EMPTY' WHEN b % 9 = 4 THEN 'TOO_LARGE' WHEN pid IS NOT NULL THEN 'REUSE' ELSE 'PARSE' END AS action, count(*) AS files, sum(CASE WHEN r = 1 AND b % 9 > 4 THEN pid END)::BIGINT AS parses FROM f LEFT JOIN g USING (h) GROUP BY 1""")
def attachment_plan(spark, sf_dir):
    from pyspark.sql import Window

    m = F.col("l_suppkey") % 9
    li = t(spark, sf_dir, "lineitem").withColumn("c", F.count("*").over(Window.partitionBy("l_orderkey", "l_linenumber", "l_suppkey"))).where("c = 1")
    f = li.select(F.col("l_suppkey").alias("batch_no"), F.col("l_orderkey").alias("posting"), F.col("l_linenumber").alias("ordinal"), F.when(m == 0, "Z").otherwise("A").alias("role"), F.when(m == 1, "doc").otherwise("PDF").alias("format"), F.when(m == 2, 404).otherwise(200).alias("http_status"), F.when(m == 3, 0).when(m == 4, 10**9).otherwise(10).alias("byte_length"), F.col("l_partkey").alias("sha256"))
    parsed = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("sha256"), F.lit("v1").alias("parser_revision"), F.when(F.col("p_size") % 3 == 0, "PARSED").otherwise("ERROR").alias("state"), F.lit(0).alias("failed_members"), F.col("p_size").alias("finished_at"), F.col("p_size").alias("parse_id"))
    return claims.attachment_plan(f, parsed, "v1").groupBy("action").agg(F.count("*").alias("files"), F.sum("parse_id").cast("long").alias("parses"))


@query("""WITH s AS (SELECT conv_id, turn, coalesce(text, '') AS text, coalesce(sum(length(coalesce(text, '')) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM conversations) SELECT conv_id, sha256(string_agg(text, chr(10) ORDER BY turn)) AS text_hash, string_agg(turn || ':' || start || ':' || (start + length(text)), ',' ORDER BY turn) AS sections FROM s GROUP BY 1""")
def input_bundles(spark, sf_dir):
    s = t(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("n"), F.coalesce("text", F.lit("")).alias("text"))
    return claims.input_bundle(s, ["conv_id"]).select("conv_id", F.sha2("text", 256).alias("text_hash"), F.array_join(F.transform("sections", lambda x: F.concat_ws(":", x["n"], x["start"], x["stop"])), ",").alias("sections"))


@query("""SELECT c_custkey::VARCHAR AS node_id, 'name' AS path, 'MIN_COUNT' AS issue FROM customer WHERE c_custkey % 6 = 0 UNION ALL SELECT c_custkey::VARCHAR, 'name', 'MAX_COUNT' FROM customer WHERE c_custkey % 6 = 1 UNION ALL SELECT c_custkey::VARCHAR, 'name', 'PATTERN' FROM customer WHERE c_custkey % 6 = 2 UNION ALL SELECT c_custkey::VARCHAR, 'nation', 'WRONG_KIND' FROM customer WHERE c_custkey % 6 = 3""")
def shape_validation(spark, sf_dir):
    c, k = t(spark, sf_dir, "customer"), F.col("c_custkey")
    nodes = c.select(_s("c_custkey").alias("node_id"), F.lit("Customer").alias("label")).unionByName(t(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("node_id"), F.lit("Nation").alias("label")))
    name = c.where(k % 6 != 0).select(_s("c_custkey").alias("node_id"), F.lit("name").alias("path"), F.when(k % 6 == 2, "x").otherwise(F.col("c_name")).alias("value"))
    nation = c.select(_s("c_custkey").alias("node_id"), F.lit("nation").alias("path"), F.when(k % 6 == 3, _s("c_custkey")).otherwise(F.concat(F.lit("n"), "c_nationkey")).alias("value"))
    shapes = [{"label": "Customer", "path": "name", "least": 1, "most": 1, "pattern": "^Customer#"}, {"label": "Customer", "path": "nation", "of": "Nation"}]
    return claims.shape_issues(nodes, name.unionByName(name.where("CAST(node_id AS bigint) % 6 = 1")).unionByName(nation), shapes)


# --- scalars and small forms ---


@query("""SELECT l_returnflag, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS first_id FROM lineitem GROUP BY 1""")
def first_and_count_any(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return li.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.min_by("id", "id").alias("first_id"))


@query("""SELECT l_orderkey AS k, bool_or(l_returnflag = 'R') AND bool_or(l_returnflag = 'A') AS has_all, bool_or(l_returnflag IN ('R', 'N')) AS has_any, string_agg(DISTINCT l_returnflag, '' ORDER BY l_returnflag) FILTER (WHERE l_returnflag <> 'N') AS rest FROM lineitem GROUP BY 1""")
def array_sets(spark, sf_dir):
    d = t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_set("l_returnflag")).alias("s"))
    ra, rn, n = (F.array(*map(F.lit, x)) for x in ("RA", "RN", "N"))
    return d.select("k", (F.size(F.array_except(ra, F.col("s"))) == 0).alias("has_all"), F.arrays_overlap(F.col("s"), rn).alias("has_any"), F.nullif(F.array_join(F.array_except(F.col("s"), n), ""), F.lit("")).alias("rest"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey END AS n, CASE WHEN c_custkey % 3 <> 2 THEN NULL ELSE c_custkey / 4.0 END AS d, c_custkey % 5 = 0 AS yes FROM customer""")
def guarded_casts(spark, sf_dir):
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, "x1").otherwise(k.cast("string"))
    return t(spark, sf_dir, "customer").select("c_custkey", raw.try_cast("long").alias("n"), F.when(k % 3 == 2, (k / 4).cast("string")).otherwise("1e").try_cast("double").alias("d"), F.when(k % 5 == 0, "true").otherwise("no").try_cast("boolean").alias("yes"))


@query("""SELECT event_id, '{"id":' || event_id || ',"kind":"' || event_type || '","tags":["a","' || event_type || '"]' || CASE WHEN event_id % 2 = 0 THEN ',"note":"x"' ELSE '' END || '}' AS body, 3 + (event_id % 2 = 0)::INT AS members FROM events""")
def json_build_and_read(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.array(F.lit("a"), F.col("event_type")).alias("tags"), F.when(F.col("event_id") % 2 == 0, "x").alias("note"))).alias("body"))
    return e.select("event_id", "body", F.size(F.json_object_keys("body")).alias("members"))


@query("""SELECT event_id, 'k' AS path, 'LONG' AS type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS long_value FROM events UNION ALL SELECT event_id, 't', 'TEXT', NULL FROM events""")
def typed_properties(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("event_id", F.concat(F.expr("left(props, length(props) - 1)"), F.lit(',"t":"'), "event_type", F.lit('"}')).alias("j"))
    return graph.typed_properties(graph.flat_properties(e, "event_id", "j"), "event_id").select("event_id", "path", "type", "long_value")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN true WHEN 2 THEN true ELSE false END AS ok FROM customer""")
def language_gate(spark, sf_dir):
    k = F.col("c_custkey")
    body = F.when(k % 4 == 0, F.concat(F.repeat(F.lit("가"), 100), F.repeat(F.lit("a"), 200))).when(k % 4 == 1, F.concat(F.repeat(F.lit("가"), 99), F.lit("a"))).when(k % 4 == 2, F.lit("abc")).otherwise(F.concat(F.repeat(F.lit("가"), 100), F.repeat(F.lit("a"), 300)))
    return t(spark, sf_dir, "customer").select("c_custkey", text.language_established(body, F.when(k % 4 == 2, "ko-KR").otherwise("en")).alias("ok"))


@query("""SELECT p_partkey, p_brand || '=' || p_type || ',x=' AS pairs, 'a%20' || (p_partkey % 10) || '%2F%C3%A9' AS uri FROM part""")
def list_parts_and_uris(spark, sf_dir):
    c = text.categories(F.concat(F.lit(" "), "p_brand", F.lit(" ,, x")), F.concat("p_type", F.lit(" , ")))
    p = t(spark, sf_dir, "part")
    said = F.array_join(F.transform(c, lambda x: F.concat(x["code"], F.lit("="), F.coalesce(x["name"], F.lit("")))), ",")
    return p.select("p_partkey", said.alias("pairs"), text.percent_encode(F.concat(F.lit("a "), F.col("p_partkey") % 10, F.lit("/é"))).alias("uri"))


@query("""SELECT p_partkey, sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS UNBOUNDED PRECEDING)::BIGINT AS section FROM part""")
def running_section_numbers(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("p_brand").orderBy("p_partkey").rowsBetween(Window.unboundedPreceding, 0)
    return t(spark, sf_dir, "part").select("p_partkey", F.sum(F.when(F.col("p_size") > 25, 1).otherwise(0)).over(w).cast("long").alias("section"))


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND (o_orderkey % 4 = 0 OR o_orderdate <= TIMESTAMP '1998-01-01') AND (o_orderkey % 3 = 0 OR o_orderdate + INTERVAL 400 DAY >= TIMESTAMP '1998-01-01')""")
def open_postings(spark, sf_dir):
    from ..functions import temporal

    o, k = t(spark, sf_dir, "orders"), F.col("o_orderkey")
    d = F.to_date("o_orderdate")
    return o.where(temporal.open_on(F.lit("1998-01-01").cast("date"), F.when(k % 4 != 0, d), F.when(k % 3 != 0, F.date_add(d, 400)), F.col("o_orderstatus") == "P")).select("o_orderkey")


@query("""SELECT s.s_suppkey, p.p_brand FROM supplier s CROSS JOIN (SELECT DISTINCT p_brand FROM part) p WHERE s.s_acctbal > 0""")
def small_cross_join(spark, sf_dir):
    s = t(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey")
    brands = F.array(*map(F.lit, sorted(r[0] for r in t(spark, sf_dir, "part").select("p_brand").distinct().collect())))  # a catalogue's editions: few
    return s.select("s_suppkey", F.explode(brands).alias("p_brand"))


@query("""SELECT p_partkey, concat_ws(',', CASE WHEN regexp_matches(p_name, '(?i)^(red|blue)') THEN 'COLOUR' END, CASE WHEN regexp_matches(p_name, '(?i)gear|bolt|rod') THEN 'MACHINE' END, CASE WHEN regexp_matches(p_type, '(?i)promo') THEN 'OFFER' END, CASE WHEN regexp_matches(p_name, '(?i)(hot|cold)\\s') THEN 'HEAT' END, CASE WHEN regexp_matches(p_name, '(?i)^(small|large)\\b') THEN 'SIZE' END) AS families FROM part""")
def scope_screens(spark, sf_dir):
    said = F.concat_ws("|", "p_name", "p_type")
    rules = {"COLOUR": "^(red|blue)", "MACHINE": r"(gear|bolt|rod)[^|]*\|", "OFFER": r"\|.*promo", "HEAT": r"(hot|cold)\s", "SIZE": r"^(small|large)\b"}
    return t(spark, sf_dir, "part").select("p_partkey", F.array_join(text.scope_families(said, rules), ",").alias("families"))


# --- envelopes, bundles, catalogues, cohorts ---


@query("""SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 1 THEN 'TOTAL_MISSING' WHEN 2 THEN 'PAGE_MISMATCH' WHEN 3 THEN 'SIZE_MISMATCH' WHEN 4 THEN 'ITEMS_WITHOUT_TOTAL' WHEN 5 THEN 'TOO_MANY_ITEMS' END AS issue FROM orders""")
def envelope_metadata(spark, sf_dir):
    m = F.col("o_orderkey") % 6
    issue = readers.envelope_issue(F.lit(2), F.lit(10), F.when(m == 2, 1).when(m == 0, F.lit(None)).otherwise(2), F.when(m == 3, 20).otherwise(10), F.when(m == 1, F.lit(None)).when(m == 4, 0).otherwise(15), F.when(m == 5, 6).otherwise(5))
    return t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), issue.alias("issue"))


@query("""SELECT 'f' || p_partkey AS name, CASE WHEN p_partkey % 7 = 0 THEN 'MISSING' WHEN p_partkey % 5 = 0 THEN 'UNEXPECTED' ELSE 'CHANGED' END AS issue FROM part WHERE (p_partkey % 7 = 0) <> (p_partkey % 5 = 0) OR (p_partkey % 7 <> 0 AND p_partkey % 5 <> 0 AND p_partkey % 11 = 0)""")
def bundle_verification(spark, sf_dir):
    p = t(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("f"), "p_partkey").alias("name"), F.sha2("p_name", 256).alias("sha256"), F.length("p_name").cast("long").alias("byte_length"))
    m = p.where("p_partkey % 5 <> 0").withColumn("sha256", F.when(F.col("p_partkey") % 11 == 0, "x").otherwise(F.col("sha256")))
    return bundles.bundle_issues(p.where("p_partkey % 7 <> 0").drop("p_partkey"), m.drop("p_partkey"))


@query("""WITH r AS (SELECT l_suppkey AS code, count(DISTINCT l_linenumber) AS elements, count(*) FILTER (WHERE l_returnflag <> 'N' AND l_linestatus <> 'O') AS rated FROM lineitem GROUP BY 1) SELECT s_suppkey::VARCHAR AS code, s_name AS title, (s_suppkey::VARCHAR)[:2] AS major, coalesce(elements, 0) AS elements, coalesce(rated, 0) AS rated FROM supplier LEFT JOIN r ON r.code = s_suppkey""")
def rated_catalogue(spark, sf_dir):
    o = t(spark, sf_dir, "supplier").select(_s("s_suppkey").alias("code"), F.col("s_name").alias("title"))
    li = t(spark, sf_dir, "lineitem")
    r = li.select(_s("l_suppkey").alias("code"), _s("l_linenumber").alias("element_id"), F.lit("IM").alias("scale"), F.when(F.col("l_returnflag") != "N", 1.0).alias("value"), (F.col("l_linestatus") == "O").alias("suppress"))
    return bundles.catalogue(o, o.select("code", F.lit(None).cast("string").alias("parent")), r.select("element_id").distinct(), r)[0]


@query("""SELECT page_id, 0 AS n, CASE WHEN page_id % 3 = 0 THEN 'page' WHEN page_id % 3 = 1 THEN 'archive_section' ELSE 'body' END AS kind, CASE WHEN page_id % 3 = 1 THEN 'a.txt' END AS name, CASE WHEN page_id % 3 = 1 THEN 'a.txt ' ELSE '' END || 'one ' || page_id AS text FROM pages UNION ALL SELECT page_id, 1, 'page', NULL, 'two' FROM pages WHERE page_id % 3 = 0""")
def parsed_sections(spark, sf_dir):
    k = F.col("page_id")
    inner = F.when(k % 3 == 0, F.concat(F.lit('<div class="page"><p>one\n '), k, F.lit('</p></div><div class="page"/><div class="page">two</div>'))).when(k % 3 == 1, F.concat(F.lit('<div class="package-entry"><h1>a.txt</h1> <div class="page">one '), k, F.lit("</div></div>"))).otherwise(F.concat(F.lit("one "), k))
    d = t(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("<html><head><title>t</title></head><body>"), inner, F.lit("</body></html>")).alias("x"))
    s = documents.xml_sections(d, "page_id", "x").where("error_code IS NULL")
    from pyspark.sql import Window

    return s.withColumn("n", F.row_number().over(Window.partitionBy("page_id").orderBy("n")) - 1).select("page_id", "n", "kind", "name", "text")


@query("""WITH x AS (SELECT lpad((c_custkey % 40)::VARCHAR, 2, '0') || '-' || c_custkey AS code, c_custkey AS k, CASE WHEN c_custkey < 40 THEN 1 ELSE 2 END AS level FROM customer), p AS (SELECT code, k, lpad((k % 40)::VARCHAR, 2, '0') || '-' || (k % 40) AS parent, k % 40 AS pk FROM x WHERE k >= 40 AND k % 9 <> 1)
SELECT code, 'NO_PARENT' AS issue FROM x WHERE k >= 40 AND k % 9 = 1 UNION ALL SELECT code, 'SEVERAL_PARENTS' FROM p WHERE k % 9 = 2 AND k % 40 <> 39 UNION ALL SELECT code, 'MAJOR' FROM p WHERE k % 9 = 2 AND k % 40 <> 39 UNION ALL SELECT code, 'ROOT_WITH_PARENT' FROM x WHERE k = 3 UNION ALL SELECT code, 'LEVEL' FROM x WHERE k = 3 UNION ALL SELECT code, 'MAJOR' FROM x WHERE k = 3 UNION ALL SELECT 'bad', 'CODE_PATTERN' FROM region WHERE r_regionkey = 0""")
def coded_taxonomy(spark, sf_dir):
    k = F.col("c_custkey")
    c = t(spark, sf_dir, "customer")
    name = lambda n: F.concat(F.lpad((n % 40).cast("string"), 2, "0"), F.lit("-"), n)
    items = c.select(name(k).alias("code"), F.when(k < 40, 1).otherwise(2).alias("level")).unionByName(spark.createDataFrame([("bad", 1)], "code string, level int"))
    links = c.where("c_custkey >= 40 AND c_custkey % 9 <> 1").select(name(k).alias("child"), name(k % 40).alias("parent"))
    more = c.where("c_custkey >= 40 AND c_custkey % 9 = 2 AND c_custkey % 40 <> 39").select(name(k).alias("child"), name(F.lit(39)).alias("parent"))
    root = c.where("c_custkey = 3").select(name(k).alias("child"), name(F.lit(5)).alias("parent"))
    return graph.taxonomy_validity(items, links.unionByName(more).unionByName(root), "^[0-9]{2}-[0-9]+$")


@query("""WITH c AS (SELECT c_custkey AS e, CASE WHEN c_custkey % 5 = 0 THEN 'EXCLUDED' ELSE 'INCLUDED' END AS o FROM customer), t AS (SELECT o_custkey AS e, string_agg(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END, ',' ORDER BY CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS tracks FROM orders GROUP BY 1)
SELECT e AS entity, CASE WHEN o = 'INCLUDED' AND tracks IS NULL THEN 'EXCLUDED' ELSE o END AS outcome, coalesce(tracks, '') AS tracks, CASE WHEN o = 'EXCLUDED' THEN 'OLD' WHEN tracks IS NULL AND e IN (SELECT o_custkey FROM orders) THEN 'NOT_F,NO_QUALIFYING_TRACK' WHEN tracks IS NULL THEN 'NO_QUALIFYING_TRACK' ELSE '' END AS reasons FROM c LEFT JOIN t USING (e)""")
def cohort_tracks(spark, sf_dir):
    k = F.col("c_custkey")
    c = t(spark, sf_dir, "customer").select(k.alias("entity"), F.when(k % 5 == 0, "EXCLUDED").otherwise("INCLUDED").alias("outcome"), F.when(k % 5 == 0, F.array(F.lit("OLD"))).otherwise(F.array().cast("array<string>")).alias("reasons"))
    tr = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity"), F.col("o_orderpriority").alias("profile"), "o_orderstatus")
    d = cohort.tracks(c, tr, F.array_compact(F.array(F.when(F.col("o_orderstatus") != "F", "NOT_F"))))
    return d.select("entity", "outcome", F.array_join("tracks", ",").alias("tracks"), F.array_join("reasons", ",").alias("reasons"))


@query("""SELECT c_custkey AS entity, CASE WHEN c_custkey % 3 = 0 OR d IS NULL THEN 'NOT_SERVED' WHEN closed THEN 'CLOSED' WHEN d::DATE < DATE '2000-06-01' THEN 'EXPIRED' WHEN c_custkey % 4 = 0 THEN 'STALE' ELSE 'ACTIVE' END AS state, coalesce(n, 0) AS claims, coalesce(f, 0) AS supported FROM customer LEFT JOIN (SELECT o_custkey AS k, max(o_orderdate) AS d, bool_or(o_orderkey % 50 = 0) AS closed, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 4 > 0) AS f FROM orders GROUP BY 1) ON k = c_custkey WHERE c_custkey % 3 <> 0""")
def cohort_serving(spark, sf_dir):
    k = F.col("c_custkey")
    c = t(spark, sf_dir, "customer").select(k.alias("entity"), F.when(k % 3 == 0, "EXCLUDED").otherwise("INCLUDED").alias("outcome"))
    o = t(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "entity")
    p = o.groupBy("entity").agg(F.bool_or(F.col("o_orderkey") % 50 == 0).alias("closed"), F.to_date(F.max("o_orderdate")).alias("last_day")).withColumn("last_seen_at", F.when(F.col("entity") % 4 == 0, "2000-01-01").otherwise("2000-05-31").cast("timestamp"))
    s = cohort.serving_state(c, p, "2000-06-01 00:00:00", 172800).where("outcome = 'INCLUDED'")
    return s.join(cohort.claim_support(c, o.select("entity", F.col("o_orderkey").alias("claim"), (F.col("o_orderkey") % 4).alias("evidence"))), "entity").select("entity", "state", "claims", "supported")


@query("""SELECT o_orderstatus AS outcome, count(*) AS members FROM orders GROUP BY 1""")
def cohort_manifest(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("entity"), F.col("o_orderstatus").alias("outcome"), F.array(F.col("o_orderpriority")).alias("reasons"))
    a, b = cohort.manifest(o), cohort.manifest(o.repartition(5, "reasons"))
    changed = cohort.manifest(o.withColumn("reasons", F.when(F.col("entity") == 1, F.array()).otherwise(F.col("reasons"))))
    return a.join(b, ["outcome", "members", "hash"]).join(changed.select(F.col("outcome"), F.lit(1).alias("x")), "outcome").select("outcome", "members")
