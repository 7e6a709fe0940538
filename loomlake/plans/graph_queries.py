"""Graph projections, seals, bundles and JSON-LD lines over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import projection
from .registry import query, t


def _s(c):
    return F.col(c).cast("string")


@query("""WITH c AS (SELECT o_custkey::VARCHAR AS identity, o_orderkey AS record, o_orderstatus AS source, o_orderpriority AS run, o_orderdate AS pos, o_orderkey % 2 = 0 AS detail, CASE WHEN o_orderkey % 3 = 0 THEN '  ' WHEN o_orderkey % 3 = 1 THEN NULL ELSE ' n' || o_orderkey END AS name FROM orders),
f AS (SELECT identity, record, source FROM c QUALIFY row_number() OVER (PARTITION BY identity ORDER BY CASE WHEN source = 'F' THEN 0 ELSE 1 END, pos DESC, run DESC, detail DESC, record DESC) = 1),
n AS (SELECT identity, record, nullif(trim(name), '') AS name FROM c QUALIFY row_number() OVER (PARTITION BY identity ORDER BY nullif(trim(name), '') IS NULL, CASE WHEN source = 'P' THEN 0 ELSE 1 END, pos DESC, run DESC, detail DESC, record DESC) = 1)
SELECT identity, f.record AS fact_record, source, n.record AS name_record, coalesce(n.name, 'Customer ' || identity) AS name FROM f JOIN n USING (identity)""")
def golden_entities(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    c = o.select(
        _s("o_custkey").alias("identity"), F.lit("Customer").alias("kind"), _s("o_custkey").alias("code"), F.col("o_orderstatus").alias("source"), F.col("o_orderpriority").alias("run"), F.col("o_orderdate").alias("created_at"), (k % 2 == 0).alias("detail"), k.alias("record"),
        F.when(k % 3 == 0, "  ").when(k % 3 == 2, F.concat(F.lit(" n"), k)).alias("name"), F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("owner_priority"), F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("name_priority"), F.lit("{}").alias("facts"),
    )
    return projection.entities(c).select("identity", "fact_record", "source", "name_record", "name")


_PAIRS = """p AS (SELECT o_custkey::VARCHAR AS owner, o_orderstatus AS source, o_orderpriority AS run, o_orderdate AS pos, o_orderkey AS record, o_custkey::VARCHAR AS subject, 'S' || (l_suppkey % 10) AS object, 'USES' AS predicate FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
w AS (SELECT owner, source, arg_max(run, (pos, run)) AS run FROM p GROUP BY ALL), k AS (SELECT p.*, CASE WHEN source = 'F' THEN record::VARCHAR ELSE '' END AS scope FROM p JOIN w USING (owner, source, run)),
e AS (SELECT owner, source, subject, object, predicate, scope, max(record) AS record, sha256(concat_ws(chr(10), source, owner, subject, object, predicate, scope)) AS edge_key FROM k GROUP BY ALL)"""


def _owned(spark, sf_dir):
    o = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "lineitem", F.col("l_orderkey").alias("o_orderkey"), "l_suppkey"), "o_orderkey")
    pairs = o.select(_s("o_custkey").alias("owner"), F.col("o_orderstatus").alias("source"), F.col("o_orderpriority").alias("run"), F.col("o_orderdate").alias("created_at"), F.col("o_orderkey").alias("record"), _s("o_custkey").alias("subject"), F.concat(F.lit("S"), F.col("l_suppkey") % 10).alias("object"), F.lit("USES").alias("predicate"))
    return pairs, projection.owned_edges(pairs, F.col("source") == "F")


@query(f"WITH {_PAIRS} SELECT owner, source, object, record, edge_key FROM e")
def owned_edges(spark, sf_dir):
    return _owned(spark, sf_dir)[1].select("owner", "source", "object", "record", "edge_key")


@query(f"WITH {_PAIRS}, o AS (SELECT DISTINCT owner, source FROM p UNION SELECT c_custkey::VARCHAR, 'none' FROM customer) SELECT o.owner, o.source, coalesce(string_agg(edge_key, ',' ORDER BY edge_key), '') AS edge_keys FROM o LEFT JOIN e USING (owner, source) GROUP BY ALL")
def expected_edge_keys(spark, sf_dir):
    pairs, edges = _owned(spark, sf_dir)
    owners = pairs.select("owner", "source").unionByName(t(spark, sf_dir, "customer").select(_s("c_custkey").alias("owner"), F.lit("none").alias("source")))
    return projection.expected_edges(owners, edges)


@query("""WITH a AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 5 <> 0), b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN 'X' ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 3 <> 0)
SELECT coalesce(a.k, b.k) AS node_id, CASE WHEN b.k IS NULL THEN 'MISSING' WHEN a.k IS NULL THEN 'UNEXPECTED' ELSE 'CHANGED' END AS issue FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.v <> b.v""")
def written_graph_difference(spark, sf_dir):
    c = t(spark, sf_dir, "customer", F.col("c_custkey").alias("node_id"), F.col("c_mktsegment").alias("content_hash"))
    return projection.written_difference(c.where("node_id % 5 <> 0"), c.where("node_id % 3 <> 0").withColumn("content_hash", F.when(F.col("node_id") % 7 == 0, "X").otherwise(F.col("content_hash"))), "node_id", "content_hash")


_NODES = """n AS (SELECT 'entity/' || c_custkey AS node_id, map {{'code': c_custkey::VARCHAR, 'kind': 'K' || c_custkey % 3}} AS p, c_custkey AS k FROM customer),
r AS (SELECT 'revision/' || c_custkey AS node_id, map_from_entries(list_filter([{{'k': 'code', 'v': c_name}}, {{'k': 'revision_id', 'v': 'r' || c_custkey}}, {{'k': 'kind', 'v': 'K' || CASE WHEN c_custkey % 11 = 0 THEN 9 ELSE c_custkey % 3 END}}, {{'k': 'segment', 'v': c_mktsegment}}, {{'k': CASE WHEN c_custkey % 13 = 0 THEN 'revision_code' END, 'v': 'x'}}], lambda x: x.k IS NOT NULL)) AS p, c_custkey AS k FROM customer WHERE c_custkey % 2 = 0)"""


def _flat(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    entity = c.select(F.concat(F.lit("entity/"), k).alias("node_id"), F.create_map(F.lit("code"), k.cast("string"), F.lit("kind"), F.concat(F.lit("K"), F.when(k % 13 == 0, 8).otherwise(k % 3)), F.lit("taken"), F.lit("y")).alias("properties"))
    rev = c.where(k % 2 == 0).select(F.concat(F.lit("revision/"), k).alias("node_id"), F.create_map(F.lit("code"), F.col("c_name"), F.lit("revision_id"), F.concat(F.lit("r"), k), F.lit("kind"), F.concat(F.lit("K"), F.when(k % 13 == 0, 8).when(k % 11 == 0, 9).otherwise(k % 3)), F.when(k % 7 == 0, "taken").otherwise("segment"), F.col("c_mktsegment")).alias("properties"))
    bind = c.where(k % 2 == 0).select(F.concat(F.lit("revision/"), k).alias("revision_id"), F.concat(F.lit("entity/"), k).alias("entity_id"))
    return entity.unionByName(rev), bind


@query("""SELECT 'entity/' || c_custkey AS node_id, CASE WHEN c_custkey % 2 <> 0 THEN NULL WHEN c_custkey % 11 = 0 AND c_custkey % 13 <> 0 THEN 'IDENTITY_CONFLICT' WHEN c_custkey % 7 = 0 THEN 'PROPERTY_COLLISION' END AS issue,
CASE WHEN c_custkey % 2 = 0 THEN c_name END AS revision_code, CASE WHEN c_custkey % 2 = 0 THEN 'r' || c_custkey END AS selected, c_custkey::VARCHAR AS code, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 7 <> 0 THEN c_mktsegment END AS segment FROM customer""")
def flat_graph_nodes(spark, sf_dir):
    d = projection.flat_nodes(*_flat(spark, sf_dir))
    get = lambda n: F.try_element_at("properties", F.lit(n))
    return d.select("node_id", "issue", get("revision_code").alias("revision_code"), get("selected_revision_id").alias("selected"), get("code").alias("code"), get("segment").alias("segment"))


@query("""WITH e AS (SELECT 'e' || o_orderkey AS edge_id, CASE WHEN o_orderkey % 4 = 0 THEN 'entity/' ELSE 'revision/' END || o_custkey AS s, CASE o_orderkey % 5 WHEN 0 THEN 'HAS_REVISION' WHEN 1 THEN 'INCLUDES' WHEN 2 THEN 'SELECTS_REVISION' ELSE 'KNOWS' END AS p, CASE WHEN o_orderkey % 3 = 0 THEN 'entity/' ELSE 'revision/' END || ((o_custkey + 3) % 1500) AS o, o_custkey AS a, (o_custkey + 3) % 1500 AS b, o_orderkey AS k FROM orders),
x AS (SELECT *, k % 4 <> 0 AND a % 2 = 0 AND a IN (SELECT c_custkey FROM customer) AS ms, k % 3 <> 0 AND b % 2 = 0 AND b IN (SELECT c_custkey FROM customer) AS mo FROM e),
d AS (SELECT *, CASE WHEN p = 'HAS_REVISION' THEN 'DROPPED_HAS_REVISION' WHEN p = 'INCLUDES' AND mo THEN 'DROPPED_REVISION_MEMBERSHIP' WHEN ms OR mo THEN 'REROUTED' ELSE 'UNCHANGED' END AS disposition, CASE WHEN ms THEN 'entity/' || a ELSE s END AS ns, CASE WHEN mo THEN 'entity/' || b ELSE o END AS no, CASE WHEN p = 'SELECTS_REVISION' THEN 'SELECTS_ENTITY' ELSE p END AS np FROM x)
SELECT edge_id AS origin_edge_id, disposition, CASE disposition WHEN 'REROUTED' THEN sha256(concat_ws(chr(10), 'flat-graph-v1', edge_id, ns, np, no)) WHEN 'UNCHANGED' THEN edge_id END AS edge_id, CASE WHEN disposition IN ('REROUTED', 'UNCHANGED') THEN np END AS predicate, CASE WHEN disposition = 'REROUTED' AND ms THEN s END AS subject_revision_id FROM d""")
def flat_graph_edges(spark, sf_dir):
    _, bind = _flat(spark, sf_dir)
    k, a, b = F.col("o_orderkey"), F.col("o_custkey"), (F.col("o_custkey") + 3) % 1500
    side = lambda c, n: F.concat(F.when(c, "entity/").otherwise("revision/"), n)
    e = t(spark, sf_dir, "orders").select(F.concat(F.lit("e"), k).alias("edge_id"), side(k % 4 == 0, a).alias("subject_id"), F.when(k % 5 == 0, "HAS_REVISION").when(k % 5 == 1, "INCLUDES").when(k % 5 == 2, "SELECTS_REVISION").otherwise("KNOWS").alias("predicate"), side(k % 3 == 0, b).alias("object_id"))
    return projection.flat_edges(e, bind).select("origin_edge_id", "disposition", "edge_id", "predicate", "subject_revision_id")


@query("""SELECT 'revision/' || c_custkey AS node_id, 'REVISION_NOT_BOUND' AS issue FROM customer WHERE c_custkey % 5 = 1 UNION ALL SELECT 'revision/' || c_custkey, 'SEVERAL_BINDINGS' FROM customer WHERE c_custkey % 5 = 2 UNION ALL SELECT 'entity/gone', 'BOUND_NODE_MISSING' FROM region WHERE r_regionkey = 0 AND EXISTS (SELECT 1 FROM customer WHERE c_custkey % 5 = 2)""")
def flat_binding_issues(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    rev, ent = F.concat(F.lit("revision/"), k), F.concat(F.lit("entity/"), k)
    nodes = c.select(rev.alias("node_id"), F.array(F.lit("entityRevision")).alias("labels")).unionByName(c.select(ent.alias("node_id"), F.array(F.lit("entity")).alias("labels")))
    bind = c.where(k % 5 != 1).select(rev.alias("revision_id"), ent.alias("entity_id")).unionByName(c.where(k % 5 == 2).select(rev.alias("revision_id"), F.lit("entity/gone").alias("entity_id")))
    return projection.binding_issues(nodes, bind)


@query("""SELECT 'nodes' AS part, count(*) AS rows FROM customer UNION ALL SELECT 'edges', count(*) FROM orders""")
def graph_inventory(spark, sf_dir):
    n = t(spark, sf_dir, "customer").select(_s("c_custkey").alias("node_id"), F.sha2("c_name", 256).alias("content_hash"))
    e = t(spark, sf_dir, "orders").select(_s("o_orderkey").alias("edge_id"), F.sha2("o_orderstatus", 256).alias("content_hash"))
    a, b = projection.inventory(n, e), projection.inventory(n.repartition(5, "content_hash"), e.repartition(3))
    return a.join(b, ["part", "rows", "hash"]).select("part", "rows")


@query("""SELECT 'CONFLICTING_NODE_CONTENT' AS issue, c_custkey::VARCHAR AS location FROM customer WHERE c_custkey % 50 = 1 UNION ALL SELECT 'RESERVED_PROPERTY', c_custkey::VARCHAR FROM customer WHERE c_custkey % 50 = 2 UNION ALL SELECT 'END_MISSING', o_orderkey::VARCHAR FROM orders WHERE o_orderkey % 90 = 0
UNION ALL SELECT 'INVENTORY_CHANGED', 'edges' FROM region WHERE r_regionkey = 0 UNION ALL SELECT 'INVENTORY_CHANGED', 'nodes' FROM region WHERE r_regionkey = 0""")
def graph_seal_issues(spark, sf_dir):
    c, k = t(spark, sf_dir, "customer"), F.col("c_custkey")
    n = c.select(_s("c_custkey").alias("node_id"), F.when(k % 50 == 2, '{"id":1}').otherwise('{"name":1}').alias("properties"), F.sha2("c_name", 256).alias("content_hash"))
    n = n.unionByName(n.where("CAST(node_id AS bigint) % 50 = 1").withColumn("content_hash", F.lit("other")))
    e = t(spark, sf_dir, "orders").select(_s("o_orderkey").alias("edge_id"), _s("o_custkey").alias("subject_id"), F.when(F.col("o_orderkey") % 90 == 0, "gone").otherwise(_s("o_custkey")).alias("object_id"), F.lit("h").alias("content_hash"))
    return projection.seal_issues(n, e, spark.createDataFrame([("nodes", 1, "x"), ("edges", 1, "x")], "part string, rows long, hash string"))


@query("""WITH a AS (SELECT o_custkey AS k, arg_max(o_orderstatus, o_orderkey) AS d, arg_max(o_orderpriority, o_orderkey) AS h FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), l AS (SELECT o_custkey AS k, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS h FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1)
SELECT c_custkey AS release_id, CASE WHEN a.k IS NULL THEN 'PENDING' WHEN a.d = 'P' THEN 'REJECTED' WHEN a.h <> '1-URGENT' THEN 'STALE' WHEN l.k IS NULL OR l.s = 'O' THEN 'NOT_LOADED' WHEN l.h <> '1-URGENT' THEN 'STALE' ELSE 'APPROVED' END AS status FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN l ON l.k = c_custkey""")
def release_attestation(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    r = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("release_id"), F.lit("1-URGENT").alias("manifest_hash"))
    a = o.where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("release_id"), F.col("o_orderpriority").alias("manifest_hash"), F.col("o_orderkey").alias("decision_no"), F.when(F.col("o_orderstatus") == "P", "REJECT").otherwise("ACCEPT").alias("decision"))
    loads = o.where("o_orderkey % 3 <> 0").select(F.col("o_custkey").alias("release_id"), F.col("o_orderkey").alias("load_id"), F.col("o_orderdate").alias("started_at"), F.when(F.col("o_orderstatus") == "O", "FAILED").otherwise("READY").alias("state"), F.col("o_orderpriority").alias("manifest_hash"))
    return projection.attestation(r, a, loads)


@query("""WITH q AS (SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN split_part(text, ' ', 3) WHEN 1 THEN '' WHEN 2 THEN 'not there ☃' ELSE split_part(text, ' ', 2) || ' ' || split_part(text, ' ', 3) END AS quote FROM documents)
SELECT doc_id, CASE WHEN coalesce(length(quote), 0) = 0 THEN 'EMPTY_QUOTE' WHEN doc_id % 10 = 3 OR text IS NULL THEN 'ARTIFACT_MISSING' WHEN strpos(text, quote) = 0 THEN 'QUOTE_NOT_FOUND' END AS issue, CASE WHEN issue IS NULL THEN strpos(text, quote) - 1 END AS start, CASE WHEN issue IS NULL THEN strpos(text, quote) - 1 + length(quote) END AS stop FROM q""")
def evidence_spans(spark, sf_dir):
    d, k = t(spark, sf_dir, "documents", "doc_id", "text"), F.col("doc_id")
    part = lambda n: F.split_part("text", F.lit(" "), F.lit(n))
    facts = d.select("doc_id", k.alias("artifact"), F.when(k % 4 == 0, part(3)).when(k % 4 == 1, "").when(k % 4 == 2, "not there ☃").otherwise(F.concat_ws(" ", part(2), part(3))).alias("quote"))
    return projection.evidence_spans(facts, d.where(k % 10 != 3).select(k.alias("artifact"), "text")).select("doc_id", "issue", "start", "stop")


@query("""SELECT 'REFERENCE_MISSING' AS issue, o_orderkey || '/customer' AS location FROM orders WHERE o_orderkey % 40 = 1 UNION ALL SELECT 'REFERENCE_KIND', o_orderkey || '/customer' FROM orders WHERE o_orderkey % 40 = 2
UNION ALL SELECT 'FIELD_WITHOUT_SUPPORT', o_orderkey || '/status' FROM orders WHERE o_orderkey % 40 = 3 UNION ALL SELECT 'SUPPORT_WITHOUT_FIELD', o_orderkey || '/none' FROM orders WHERE o_orderkey % 40 = 4 UNION ALL SELECT 'SPAN_MISSING', o_orderkey || '/none' FROM orders WHERE o_orderkey % 40 = 4 UNION ALL SELECT 'REPEATED_ID', 'c' || c_custkey FROM customer WHERE c_custkey % 40 = 5""")
def bundle_issues(spark, sf_dir):
    o, c = t(spark, sf_dir, "orders"), t(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    fields = F.array(F.lit("status"))
    people = c.select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.lit("Customer").alias("kind"), F.array().cast("array<string>").alias("fields"))
    e = o.select(_s("o_orderkey").alias("id"), F.lit("Order").alias("kind"), fields.alias("fields")).unionByName(people).unionByName(people.join(c.where("c_custkey % 40 = 5").select(F.concat(F.lit("c"), "c_custkey").alias("id")), "id"))
    refs = o.select(_s("o_orderkey").alias("id"), F.lit("customer").alias("field"), F.when(k % 40 == 1, "gone").when(k % 40 == 2, _s("o_orderkey")).otherwise(F.concat(F.lit("c"), F.col("o_custkey") - F.col("o_custkey") % 40)).alias("target"), F.lit("Customer").alias("target_kind"))
    sup = o.where(k % 40 != 3).select(_s("o_orderkey").alias("id"), F.lit("status").alias("field"), _s("o_orderkey").alias("span_id")).unionByName(o.where(k % 40 == 4).select(_s("o_orderkey").alias("id"), F.lit("none").alias("field"), F.lit("gone").alias("span_id")))
    return projection.bundle_issues(e, refs, sup, o.select(_s("o_orderkey").alias("span_id")))


@query("""WITH c AS (SELECT p_type AS entity, p_name AS label, 1 AS priority, p_brand AS source FROM part UNION ALL SELECT p_brand, p_type, CASE WHEN p_size > 45 THEN 0 ELSE 1 END, 'b' FROM part), n AS (SELECT entity, label, min(priority) AS p, count(*) AS n FROM c GROUP BY ALL),
b AS (SELECT entity, arg_min(label, (p, -n, label)) AS label, string_agg(label, '|' ORDER BY label) AS every FROM n GROUP BY 1) SELECT entity, label, every, (SELECT count(DISTINCT source) FROM c WHERE c.entity = b.entity) AS sources FROM b""")
def entity_backbone(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    c = p.select(F.col("p_type").alias("entity"), F.lit("Type").alias("kind"), F.col("p_name").alias("label"), F.lit(1).alias("priority"), F.col("p_brand").alias("source")).unionByName(p.select(F.col("p_brand").alias("entity"), F.lit("Brand").alias("kind"), F.col("p_type").alias("label"), F.when(F.col("p_size") > 45, 0).otherwise(1).alias("priority"), F.lit("b").alias("source")))
    e, _ = projection.backbone(c, p.select(F.col("p_type").alias("subject"), F.lit("OF").alias("predicate"), F.col("p_brand").alias("object")))
    return e.select("entity", "label", F.array_join(F.array_sort(F.concat("aliases", F.array("label"))), "|").alias("every"), F.size("sources").cast("long").alias("sources"))


@query("""SELECT DISTINCT p_type AS subject, 'OF' AS predicate, p_brand AS object FROM part WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size > 25) AND p_type <> p_brand""")
def backbone_relations(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    cand = lambda d, c: d.select(F.col(c).alias("entity"), F.lit("K").alias("kind"), F.col("p_name").alias("label"), F.lit(1).alias("priority"), F.lit("s").alias("source"))
    rel = p.select(F.col("p_type").alias("subject"), F.lit("OF").alias("predicate"), F.col("p_brand").alias("object"))
    return projection.backbone(cand(p, "p_type").unionByName(cand(p.where("p_size > 25"), "p_brand")), rel.unionByName(rel.withColumn("object", F.col("subject"))))[1]


@query("""WITH n AS (SELECT '{"@id":"urn:graph:node:' || sha256('n/' || n_nationkey) || '","@type":"NATION","name":"' || n_name || '"}' AS value, 1 AS part, 'n/' || n_nationkey AS key, 0 AS sub FROM nation),
e AS (SELECT sha256('e' || n_nationkey) AS id, 'n/' || n_nationkey AS s, 'n/' || n_regionkey AS o FROM nation), x AS (SELECT * FROM n UNION ALL SELECT '{"@id":"urn:graph:edge:' || id || '","@type":"Statement","subject":"urn:graph:node:' || sha256(s) || '","predicate":"IN","object":"urn:graph:node:' || sha256(o) || '"}', 2, id, 0 FROM e
UNION ALL SELECT '{"@id":"urn:graph:node:' || sha256(s) || '","IN":"urn:graph:node:' || sha256(o) || '"}', 2, id, 1 FROM e UNION ALL SELECT '{"@context":"urn:graph:context","release":"r1"}', 0, '', 0 UNION ALL SELECT '{"@id":"urn:graph:release:r1","@type":"Release"}', 3, '', 0)
SELECT row_number() OVER (ORDER BY part, key, sub) - 1 AS n, value FROM x""")
def json_ld_lines(spark, sf_dir):
    k = t(spark, sf_dir, "nation")
    n = k.select(F.concat(F.lit("n/"), "n_nationkey").alias("node_id"), F.lit("NATION").alias("label"), F.to_json(F.struct(F.col("n_name").alias("name"))).alias("properties"))
    e = k.select(F.sha2(F.concat(F.lit("e"), "n_nationkey"), 256).alias("edge_id"), F.concat(F.lit("n/"), "n_nationkey").alias("subject_id"), F.lit("IN").alias("predicate"), F.concat(F.lit("n/"), "n_regionkey").alias("object_id"))
    return projection.json_ld_rows(n, e, "r1")
