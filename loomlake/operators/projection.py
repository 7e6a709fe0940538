"""Graph projections of records: entities with chosen owners, owned edges, flat graphs with provenance, sealed inventories, bundles.

Defined results: a choice among records ends with an id, so ties have one result; null names never win over given ones; an edge with a missing end is an issue
and never dropped silently; empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import set_hash
from ..storage import cut

FLAT = "flat-graph-v1"


def entities(candidates: DataFrame) -> DataFrame:
    """(identity, kind, code, name, name_record, fact_record, source, facts) for candidates (identity, kind, code, source, run, created_at, detail, record, name, owner_priority, name_priority, facts).

    The record that owns the facts and the one that gives the name are chosen by different orders: facts by owner, then the newest run, detail before list, the
    newest record; a name must be there first, then comes its source's priority. Without any name the entity is called by its kind and code. One aggregation.
    """
    newest = F.struct("created_at", "run", F.when(F.col("detail"), 1).otherwise(0), "record")
    c = candidates.withColumn("name", F.nullif(F.trim("name"), F.lit("")))
    own = F.struct(-F.col("owner_priority"), newest)
    named = F.struct(F.col("name").isNotNull(), -F.col("name_priority"), newest)
    a = c.groupBy("identity").agg(F.max_by(F.struct("kind", "code", "source", "record", "facts"), own).alias("f"), F.max_by(F.struct("name", "record"), named).alias("n"))
    return a.select("identity", "f.kind", "f.code", F.coalesce("n.name", F.concat_ws(" ", "f.kind", "f.code")).alias("name"), F.col("n.record").alias("name_record"), F.col("f.record").alias("fact_record"), "f.source", "f.facts")


def owned_edges(pairs: DataFrame, per_record: Column) -> DataFrame:
    """(owner, source, run, subject, object, predicate, edge_key) for pairs (owner, source, run, created_at, record, subject, object, predicate).

    Only an owner's newest run of a source counts. Edges are distinct per owner, or per record where ``per_record`` holds; of equal ones the greatest record stays.
    """
    newest = pairs.groupBy("owner", "source").agg(F.max_by("run", F.struct("created_at", "run")).alias("run"))
    p = pairs.join(newest, ["owner", "source", "run"]).withColumn("_scope", F.when(per_record, F.col("record").cast("string")).otherwise(""))
    key = ["owner", "source", "subject", "object", "predicate", "_scope"]
    e = p.groupBy(*key).agg(F.max_by(F.struct("run", "record"), "record").alias("b"))
    name = F.sha2(F.concat_ws("\n", "source", "owner", "subject", "object", "predicate", "_scope"), 256)
    return e.select("owner", "source", "b.run", "b.record", "subject", "object", "predicate", name.alias("edge_key"))


def expected_edges(owners: DataFrame, edges: DataFrame) -> DataFrame:
    """(owner, source, edge_keys): the sorted keys that a store must have for each owner, an empty text for owners without edges."""
    k = edges.groupBy("owner", "source").agg(F.array_join(F.array_sort(F.collect_list("edge_key")), ",").alias("edge_keys"))
    return owners.select("owner", "source").distinct().join(k, ["owner", "source"], "left").withColumn("edge_keys", F.coalesce("edge_keys", F.lit("")))


def written_difference(expected: DataFrame, written: DataFrame, key: str, content: str) -> DataFrame:
    """(key, issue): MISSING, UNEXPECTED or CHANGED rows of a written graph table."""
    a, b = expected.select(key, F.struct(content).alias("_a")), written.select(key, F.struct(content).alias("_b"))
    issue = F.when(F.col("_b").isNull(), "MISSING").when(F.col("_a").isNull(), "UNEXPECTED").when(~F.col("_a").eqNullSafe(F.col("_b")), "CHANGED")
    return a.join(b, key, "full").select(key, issue.alias("issue")).where("issue IS NOT NULL")


# --- flat graph ---


def flat_nodes(nodes: DataFrame, bindings: DataFrame) -> DataFrame:
    """(node_id, properties, origin_hash): revision nodes (bindings: revision_id, entity_id) folded into their entities.

    ``properties``: map. An entity keeps its own; a revision's join it under names of their own (``code`` as ``revision_code``, its id as
    ``selected_revision_id``); a revision property that the entity has already, or that differs where both must be equal, is an ``issue``.
    """
    shared = ["entity_id", "kind", "scheme_id"]
    renamed = F.create_map(*[F.lit(x) for pair in (("code", "revision_code"), ("revision_id", "selected_revision_id"), ("payload_hash", "selected_revision_payload_hash"), ("schema_version", "selected_revision_schema_version")) for x in pair])
    rev = nodes.join(bindings, nodes["node_id"] == bindings["revision_id"]).select(F.col("entity_id").alias("node_id"), F.col("properties").alias("_rev"))
    base = nodes.join(bindings.select(F.col("revision_id").alias("node_id")), "node_id", "left_anti").join(rev, "node_id", "left")
    own = F.transform_keys(F.map_filter("_rev", lambda k, v: ~k.isin(*shared) & v.isNotNull()), lambda k, v: F.coalesce(F.try_element_at(renamed, k), k))
    clash = F.size(F.array_intersect(F.map_keys("_own"), F.map_keys("properties"))) > 0
    differs = reduce(lambda x, y: x | y, [F.coalesce(F.try_element_at("properties", F.lit(s)) != F.try_element_at("_rev", F.lit(s)), F.lit(False)) for s in shared])
    d = base.withColumn("_own", F.coalesce(own, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))
    return d.select("node_id", F.map_concat("_own", F.map_filter("properties", lambda k, v: ~F.array_contains(F.map_keys("_own"), k))).alias("properties"), F.when(differs, "IDENTITY_CONFLICT").when(clash, "PROPERTY_COLLISION").alias("issue"))


def flat_edges(edges: DataFrame, bindings: DataFrame) -> DataFrame:
    """Edges (edge_id, subject_id, predicate, object_id) rerouted from revisions to entities, with ``origin_edge_id``, both revisions and ``disposition``.

    UNCHANGED, REROUTED (under a new id), DROPPED_HAS_REVISION, DROPPED_REVISION_MEMBERSHIP (``INCLUDES`` of a revision); dropped edges keep a row without a
    new id, so that every edge is accounted for.
    """
    a = bindings.select(F.col("revision_id").alias("subject_id"), F.col("entity_id").alias("_s"))
    b = bindings.select(F.col("revision_id").alias("object_id"), F.col("entity_id").alias("_o"))
    e = edges.join(a, "subject_id", "left").join(b, "object_id", "left")
    moved = F.col("_s").isNotNull() | F.col("_o").isNotNull()
    disposition = F.when(F.col("predicate") == "HAS_REVISION", "DROPPED_HAS_REVISION").when((F.col("predicate") == "INCLUDES") & F.col("_o").isNotNull(), "DROPPED_REVISION_MEMBERSHIP").when(moved, "REROUTED").otherwise("UNCHANGED")
    subject, target = F.coalesce("_s", "subject_id"), F.coalesce("_o", "object_id")
    predicate = F.when(F.col("predicate") == "SELECTS_REVISION", "SELECTS_ENTITY").otherwise(F.col("predicate"))
    new = F.sha2(F.concat_ws("\n", F.lit(FLAT), "edge_id", subject, predicate, target), 256)
    kept = disposition.isin("UNCHANGED", "REROUTED")
    return e.select(
        F.col("edge_id").alias("origin_edge_id"), disposition.alias("disposition"), F.when(disposition == "REROUTED", new).when(kept, F.col("edge_id")).alias("edge_id"), F.when(kept, subject).alias("subject_id"), F.when(kept, predicate).alias("predicate"), F.when(kept, target).alias("object_id"),
        F.when(F.col("_s").isNotNull() & kept, F.col("subject_id")).alias("subject_revision_id"), F.when(F.col("_o").isNotNull() & kept, F.col("object_id")).alias("object_revision_id"),
    )


def binding_issues(nodes: DataFrame, bindings: DataFrame) -> DataFrame:
    """(node_id, issue) for nodes (node_id, labels): revisions that are bound to nothing or to several, and bindings without their nodes."""
    is_revision = F.exists("labels", lambda x: x.endswith("Revision"))
    ids = nodes.select("node_id")
    unbound = nodes.where(is_revision).select("node_id").join(bindings.select(F.col("revision_id").alias("node_id")), "node_id", "left_anti").withColumn("issue", F.lit("REVISION_NOT_BOUND"))
    several = bindings.groupBy(F.col("revision_id").alias("node_id")).count().where("count > 1").select("node_id", F.lit("SEVERAL_BINDINGS").alias("issue"))
    ends = [bindings.select(F.col(c).alias("node_id")).distinct().join(ids, "node_id", "left_anti").withColumn("issue", F.lit("BOUND_NODE_MISSING")) for c in ("revision_id", "entity_id")]
    return reduce(DataFrame.unionByName, [unbound, several, *ends])


# --- inventories ---


def inventory(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, rows, hash): counts and set hashes of node and edge ids with their contents, to seal a release with."""
    parts = [("nodes", nodes, "node_id"), ("edges", edges, "edge_id")]
    rows = [d.select(F.lit(n).alias("part"), F.concat_ws("\n", k, "content_hash").alias("m")) for n, d, k in parts]
    return set_hash(reduce(DataFrame.unionByName, rows), ["part"], "m").select("part", F.col("members").cast("long").alias("rows"), F.col("set_hash").alias("hash"))


def seal_issues(nodes: DataFrame, edges: DataFrame, sealed: DataFrame, reserved: tuple[str, ...] = ("id", "content_hash")) -> DataFrame:
    """(issue, location): why a release may not be sealed or read: repeated node ids, reserved names, missing ends, an inventory other than the sealed (part, rows, hash)."""
    repeated = nodes.groupBy("node_id").agg(F.count_distinct("content_hash").alias("n")).where("n > 1").select(F.lit("CONFLICTING_NODE_CONTENT").alias("issue"), F.col("node_id").alias("location"))
    names = nodes.where(F.arrays_overlap(F.json_object_keys("properties"), F.array(*map(F.lit, reserved)))).select(F.lit("RESERVED_PROPERTY").alias("issue"), F.col("node_id").alias("location"))
    ends = [edges.select(F.col(c).alias("node_id"), "edge_id").join(nodes.select("node_id"), "node_id", "left_anti").select(F.lit("END_MISSING").alias("issue"), F.col("edge_id").alias("location")) for c in ("subject_id", "object_id")]
    now = inventory(nodes.dropDuplicates(["node_id"]), edges)
    changed = now.join(sealed, ["part", "rows", "hash"], "left_anti").select(F.lit("INVENTORY_CHANGED").alias("issue"), F.col("part").alias("location"))
    return reduce(DataFrame.unionByName, [repeated, names, *ends, changed])


def attestation(releases: DataFrame, approvals: DataFrame, loads: DataFrame) -> DataFrame:
    """(release_id, status) for releases (release_id, manifest_hash), approvals (release_id, manifest_hash, decision_no, decision) and loads (release_id, load_id, started_at, state, manifest_hash).

    APPROVED only where the latest approval and the latest load are of the release's present manifest; else STALE, REJECTED, NOT_LOADED or PENDING.
    """
    a = approvals.groupBy("release_id").agg(F.max_by(F.struct("decision", "manifest_hash"), "decision_no").alias("a"))
    b = loads.groupBy("release_id").agg(F.max_by(F.struct("state", "manifest_hash"), F.struct("started_at", "load_id")).alias("l"))
    d = releases.join(a, "release_id", "left").join(b, "release_id", "left")
    status = (
        F.when(F.col("a").isNull(), "PENDING").when(F.col("a.decision") == "REJECT", "REJECTED").when(~F.col("a.manifest_hash").eqNullSafe(F.col("manifest_hash")), "STALE")
        .when(F.col("l").isNull() | (F.col("l.state") != "READY"), "NOT_LOADED").when(~F.col("l.manifest_hash").eqNullSafe(F.col("manifest_hash")), "STALE").otherwise("APPROVED")
    )
    return d.select("release_id", status.alias("status"))


# --- canonical bundles ---


def evidence_spans(facts: DataFrame, texts: DataFrame) -> DataFrame:
    """Facts (record, field, artifact, quote) with ``start`` and ``stop`` of their quote in the artifact's text, or ``issue``.

    Offsets are code points, half open; the first occurrence counts; a quote that is null or empty has none.
    """
    j = facts.join(texts.select("artifact", F.col("text").alias("_t")), "artifact", "left")
    at = F.expr("locate(quote, _t)")
    issue = F.when(F.coalesce(F.length("quote"), F.lit(0)) == 0, "EMPTY_QUOTE").when(F.col("_t").isNull(), "ARTIFACT_MISSING").when(at == 0, "QUOTE_NOT_FOUND")
    ok = issue.isNull()
    return j.select(*facts.columns, F.when(ok, at - 1).cast("long").alias("start"), F.when(ok, at - 1 + F.length("quote")).cast("long").alias("stop"), issue.alias("issue"))


def bundle_issues(entities_: DataFrame, references: DataFrame, support: DataFrame, spans: DataFrame) -> DataFrame:
    """(issue, location) of a canonical bundle: repeated ids, references to nothing or to another kind, fields without support, support without a span.

    ``entities_``: (id, kind, fields array); ``references``: (id, field, target, target_kind); ``support``: (id, field, span_id); ``spans``: (span_id).
    """
    bag = lambda name, d, at: d.select(F.lit(name).alias("issue"), at.alias("location"))
    kinds = entities_.select(F.col("id").alias("target"), F.col("kind").alias("_k"))
    r = references.join(kinds, "target", "left")
    place = F.concat_ws("/", "id", "field")
    fields = entities_.select("id", F.explode("fields").alias("field"))
    return reduce(
        DataFrame.unionByName,
        [
            bag("REPEATED_ID", entities_.groupBy("id").count().where("count > 1"), F.col("id")),
            bag("REFERENCE_MISSING", r.where("_k IS NULL"), place),
            bag("REFERENCE_KIND", r.where("_k <> target_kind"), place),
            bag("FIELD_WITHOUT_SUPPORT", fields.join(support.select("id", "field"), ["id", "field"], "left_anti"), place),
            bag("SUPPORT_WITHOUT_FIELD", support.join(fields, ["id", "field"], "left_anti"), place),
            bag("SPAN_MISSING", support.join(spans, "span_id", "left_anti"), place),
        ],
    )


# --- entity backbone ---


def backbone(candidates: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities (entity, kind, label, aliases, sources), relations that are distinct, between known entities and no loops).

    ``candidates``: (entity, kind, label, priority, source). A label is the one of best priority, then the most frequent, then the first by bytes; all others are aliases.
    """
    n = candidates.where("label IS NOT NULL").groupBy("entity", "kind", "label").agg(F.min("priority").alias("p"), F.count("*").alias("n"))
    best = n.groupBy("entity", "kind").agg(F.min_by("label", F.struct("p", -F.col("n"), "label")).alias("label"), F.array_sort(F.collect_set("label")).alias("_all"))
    sources = candidates.groupBy("entity", "kind").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    e = sources.join(best, ["entity", "kind"], "left").select("entity", "kind", F.coalesce("label", "entity").alias("label"), F.coalesce(F.array_remove("_all", F.col("label")), F.array().cast("array<string>")).alias("aliases"), "sources")
    known = e.select("entity").distinct()
    r = relations.where("subject <> object").distinct()
    return e, r.join(known.withColumnRenamed("entity", "subject"), "subject", "left_semi").join(known.withColumnRenamed("entity", "object"), "object", "left_semi").select("subject", "predicate", "object")


# --- JSON-LD rows ---


def json_ld_rows(nodes: DataFrame, edges: DataFrame, release: str, base: str = "urn:graph:") -> DataFrame:
    """(n, value): lines of a release: a header, nodes by id, two lines an edge (the statement about it, then the triple), the release's root last.

    Order is that of bytes. Line numbers come from per-partition counts, so no task sorts or numbers all rows.
    """
    iri = lambda c: F.concat(F.lit(base + "node:"), F.sha2(c, 256))
    obj = lambda *cs: F.to_json(F.struct(*cs))
    typed = F.col("properties")
    head = F.regexp_replace(obj(iri(F.col("node_id")).alias("@id"), F.col("label").alias("@type")), r"\}$", "")
    body = F.when(typed.isNull() | (typed == "{}"), "").otherwise(F.concat(F.lit(","), F.expr("substring(properties, 2, length(properties) - 2)")))
    a = nodes.select(F.lit(1).alias("part"), F.col("node_id").alias("key"), F.lit(0).alias("sub"), F.concat(head, body, F.lit("}")).alias("value"))
    statement = obj(F.concat(F.lit(base + "edge:"), "edge_id").alias("@id"), F.lit("Statement").alias("@type"), iri(F.col("subject_id")).alias("subject"), F.col("predicate").alias("predicate"), iri(F.col("object_id")).alias("object"))
    triple = F.to_json(F.map_from_arrays(F.array(F.lit("@id"), F.col("predicate")), F.array(iri(F.col("subject_id")), iri(F.col("object_id")))))
    b = edges.select(F.lit(2).alias("part"), F.col("edge_id").alias("key"), F.posexplode(F.array(statement, triple)).alias("sub", "value"))
    spark = nodes.sparkSession
    ends = spark.createDataFrame([(0, "", 0, f'{{"@context":"{base}context","release":"{release}"}}'), (3, "", 0, f'{{"@id":"{base}release:{release}","@type":"Release"}}')], "part int, key string, sub int, value string")
    rows = cut(a.unionByName(b).unionByName(ends).repartitionByRange("part", "key", "sub").sortWithinPartitions("part", "key", "sub").withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id() % (1 << 33)))
    sizes = {r["_p"]: r["count"] for r in rows.groupBy("_p").count().collect()}  # one number a partition
    starts, total = {}, 0
    for p in sorted(sizes):
        starts[p], total = total, total + sizes[p]
    offset = F.try_element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("_p")) if starts else F.lit(0)
    return rows.select((offset + F.col("_i")).cast("long").alias("n"), "value")
