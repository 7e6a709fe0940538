"""Answers and claims: citation rules, accounting of passages, evidence in line ranges, postings of several sources, inferred occupations, attachments, shapes.

Issues are bags of codes in the order of the rules. Null texts hold no quote; offsets are code points, half open.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold_space


def match_issues(answers: DataFrame, answer_id: str, most: int = 2, quotes: int = 6) -> DataFrame:
    """(answer_id, issue) for answers (matches: array of (code, quotes: array of (field, quote)), shortlist: array, fields: map<string,string>).

    Too many matches, a code twice or outside the shortlist, 1 to ``quotes`` quotes each, every quote a literal part of the field that it names.
    """
    m = F.col("matches")
    bad = lambda x: (F.size(x["quotes"]) < 1) | (F.size(x["quotes"]) > quotes)
    absent = lambda x: F.exists(x["quotes"], lambda q: ~F.coalesce(F.contains(F.try_element_at("fields", q["field"]), q["quote"]) & (q["quote"] != ""), F.lit(False)))
    codes = F.transform(m, lambda x: x["code"])
    steps = {"TOO_MANY_MATCHES": F.size(m) > most, "REPEATED_CODE": F.size(F.array_distinct(codes)) < F.size(m), "OUTSIDE_SHORTLIST": F.size(F.array_except(codes, F.col("shortlist"))) > 0, "QUOTE_COUNT": F.exists(m, bad), "QUOTE_NOT_IN_FIELD": F.exists(m, absent)}
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in steps.items()]))
    return answers.select(answer_id, F.explode(found).alias("issue"))


def anchor_issues(answers: DataFrame, answer_id: str, alternatives: str = r"\bor\b|또는|혹은") -> DataFrame:
    """(answer_id, issue) for answers (text, anchors: array): several roles need anchors that stand in the text in order, don't overlap and have no word of choice between them."""

    def place(acc: Column, x: Column) -> Column:
        at = F.instr(F.substring(F.col("text"), acc["end"] + 1, F.length("text")), x)
        ok = (at > 0) & (x != "")
        start = acc["end"] + at - 1
        between = F.substring(F.col("text"), acc["end"] + 1, at - 1)
        choice = ok & acc["any"] & between.rlike(f"(?i){alternatives}")
        return F.struct(F.when(ok, start + F.length(x)).otherwise(acc["end"]).cast("int").alias("end"), (acc["lost"] | ~F.coalesce(ok, F.lit(False))).alias("lost"), (acc["choice"] | F.coalesce(choice, F.lit(False))).alias("choice"), F.lit(True).alias("any"))

    first = F.struct(F.lit(0).alias("end"), F.lit(False).alias("lost"), F.lit(False).alias("choice"), F.lit(False).alias("any"))
    d = answers.where(F.size("anchors") > 1).withColumn("_a", F.aggregate("anchors", first, place))
    found = F.array_compact(F.array(F.when(F.col("_a.lost"), "ANCHORS_NOT_IN_ORDER"), F.when(F.col("_a.choice"), "ALTERNATIVE_BETWEEN_ANCHORS")))
    return d.select(answer_id, F.explode(found).alias("issue"))


def ranked_quote_issues(answers: DataFrame, answer_id: str, most: int = 3, low: int = 2, high: int = 500) -> DataFrame:
    """(answer_id, issue) for answers (items: array of (rank, quotes: array), leaves: array of source texts): ranks 1..n, 1 to ``most`` quotes of ``low`` to ``high`` characters, each in some leaf."""
    i = F.col("items")
    ranks = F.transform(i, lambda x: x["rank"])
    steps = {
        "RANKS": F.when(F.size(i) > 0, ranks != F.sequence(F.lit(1), F.size(i))).otherwise(False), "QUOTE_COUNT": F.exists(i, lambda x: ~F.size(x["quotes"]).between(1, most)), "QUOTE_LENGTH": F.exists(i, lambda x: F.exists(x["quotes"], lambda q: ~F.length(q).between(low, high))),
        "QUOTE_NOT_FOUND": F.exists(i, lambda x: F.exists(x["quotes"], lambda q: ~F.exists(F.col("leaves"), lambda s: F.contains(s, q)))),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in steps.items()]))
    return answers.select(answer_id, F.explode(found).alias("issue"))


def passage_accounting(passages: DataFrame, citations: DataFrame, dispositions: DataFrame, key: str) -> DataFrame:
    """(key, n, issue): every narrative passage is cited or has exactly one disposition, not both; nothing is said of passages that aren't there.

    ``passages``: (key, n, narrative); ``citations``: (key, n); ``dispositions``: (key, n, kind).
    """
    c = citations.select(key, "n").distinct().withColumn("_cited", F.lit(True))
    d = dispositions.groupBy(key, "n").agg(F.count("*").alias("_d"))
    j = passages.join(c, [key, "n"], "full").join(d, [key, "n"], "full")
    cited, said = F.coalesce("_cited", F.lit(False)), F.coalesce("_d", F.lit(0))
    known = F.col("narrative").isNotNull()
    steps = [(~known, "UNKNOWN_PASSAGE"), (known & (said > 1), "DUPLICATE_DISPOSITION"), (known & cited & (said > 0), "CONFLICTING_DISPOSITION"), (F.col("narrative") & ~cited & (said == 0), "UNACCOUNTED_PASSAGE")]
    return j.select(key, "n", F.explode(F.array_compact(F.array(*[F.when(c, n) for c, n in steps]))).alias("issue"))


def fragment_issues(parts: DataFrame, part_id: str) -> DataFrame:
    """(part_id, issue): each of a part's fragments must stand, white space folded, in one of its quotes; no fragments are unsupported too."""
    quotes = F.transform("quotes", lambda q: fold_space(q))
    ok = (F.size("fragments") > 0) & F.forall("fragments", lambda x: F.exists(quotes, lambda q: F.contains(q, fold_space(x))))
    return parts.where(~F.coalesce(ok, F.lit(False))).select(part_id, F.lit("UNSUPPORTED_FRAGMENT").alias("issue"))


def evidence_in_lines(claims: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Claims (key, claim, first_line, last_line, quote) with ``start`` and ``stop``: the first place, white space folded, in the cited lines, mapped back to the whole text.

    ``lines``: (key, n, start, text) with LF ends. A claim whose quote isn't there has nulls.
    """
    j = claims.join(lines.select(key, "n", F.col("start").alias("_s"), F.col("text").alias("_t")), key).where("n BETWEEN first_line AND last_line")
    body = F.array_sort(F.collect_list(F.struct("n", "_s", "_t")))
    g = j.groupBy(key, "claim").agg(body.alias("_l"))
    text = F.array_join(F.transform("_l", lambda x: x["_t"]), "\n")
    pattern = F.regexp_replace(F.regexp_replace(fold_space(F.col("quote")), r"([\\.\[\]{}()*+?^$|#&~-])", r"\\$1"), " ", r"\\s+")
    d = claims.join(g, [key, "claim"], "left").withColumns({"_x": text, "_q": pattern})
    found = F.regexp_substr("_x", F.col("_q"))
    at = F.when((F.col("_q") != "") & found.isNotNull(), F.instr(F.col("_x"), found))
    start = F.when(at > 0, F.col("_l")[0]["_s"] + at - 1)
    return d.select(*claims.columns, start.cast("long").alias("start"), (start + F.length(found)).cast("long").alias("stop"))


def common_postings(sources: dict[str, tuple[DataFrame, dict[str, Column | None]]]) -> DataFrame:
    """(source_id, posting_key, title, organization, first_day, last_day, text, facts_hash): postings of several sources in one form; what a source lacks is null."""
    names = ("posting_key", "title", "organization", "first_day", "last_day", "text")
    kinds = {"first_day": "date", "last_day": "date"}
    parts = []
    for source, (df, columns) in sources.items():
        d = df.select(F.lit(source).alias("source_id"), *[(columns.get(n) if columns.get(n) is not None else F.lit(None)).cast(kinds.get(n, "string")).alias(n) for n in names])
        parts.append(d.withColumn("facts_hash", F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)))
    return reduce(DataFrame.unionByName, parts)


def inferred_context(inferences: DataFrame, observations: DataFrame, catalog_hash: Column) -> DataFrame:
    """Inferences (association_id, source_id, posting_key, occupation, source_hash, catalog_hash) with ``source_freshness`` and ``catalog_freshness``.

    CURRENT where the stored hash is that of the present observation (source_id, posting_key, facts_hash), STALE where it isn't or the posting is gone, UNKNOWN without a stored hash.
    """
    o = observations.select("source_id", "posting_key", F.col("facts_hash").alias("_now"))
    j = inferences.join(o, ["source_id", "posting_key"], "left")
    source = F.when(F.col("_now").isNull(), "STALE").when(F.col("source_hash").isNull(), "UNKNOWN").when(F.col("source_hash") == F.col("_now"), "CURRENT").otherwise("STALE")
    return j.select(*inferences.columns, source.alias("source_freshness"), F.when(F.col("catalog_hash").eqNullSafe(catalog_hash), "CURRENT").otherwise("STALE").alias("catalog_freshness"))


def context_summary(context: DataFrame) -> DataFrame:
    """(part, name, postings, associations) by source, by occupation and by freshness."""
    def by(part: str, column: str) -> DataFrame:
        return context.groupBy(F.lit(part).alias("part"), F.col(column).alias("name")).agg(F.count_distinct(F.struct("source_id", "posting_key")).alias("postings"), F.count("*").alias("associations"))

    return reduce(DataFrame.unionByName, [by("source", "source_id"), by("occupation", "occupation"), by("freshness", "source_freshness")])


def product_roles(links: DataFrame, postings: DataFrame, roles: DataFrame, competencies: DataFrame) -> DataFrame:
    """(role, competency, postings, links, level, products) for links (posting, competency), postings (posting, product), roles (product, role), competencies (competency, level)."""
    d = links.join(postings, "posting").join(roles, "product").join(competencies, "competency", "left")
    return d.groupBy("role", "competency").agg(F.count_distinct("posting").alias("postings"), F.count("*").alias("links"), F.max("level").alias("level"), F.array_sort(F.collect_set("product")).alias("products"))


def demand_report(links: DataFrame, code: str, posting: str, qualifications: DataFrame) -> DataFrame:
    """(code, postings, links, reviewers: map by kind, qualifications: sorted names) for links (code, posting, reviewer_kind) and qualifications (code, name)."""
    n = links.groupBy(code).agg(F.count_distinct(posting).alias("postings"), F.count("*").alias("links"))
    h = links.groupBy(code, F.coalesce("reviewer_kind", F.lit("NONE")).alias("k")).agg(F.count("*").alias("v")).groupBy(code).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("reviewers"))
    q = qualifications.groupBy(code).agg(F.array_sort(F.collect_set("name")).alias("qualifications"))
    return n.join(h, code).join(q, code, "left").withColumn("qualifications", F.coalesce("qualifications", F.array().cast("array<string>")))


def resolved_catalogue(items: DataFrame, reviews: DataFrame, computed: DataFrame) -> DataFrame:
    """(item, status, pinned) for items (item, content, actor), reviews (item, review_no, decision, reviewer, reviewer_kind, commit, merge_reference) and computed (item, content).

    ACCEPTED needs a human who isn't the author, a commit of 40 or 64 hex digits and a merge reference; REJECTED; else PENDING. ``pinned``: whether the stored content is what is computed now.
    """
    own = reviews.join(items.select("item", "actor"), "item").where("reviewer <> actor")
    r = own.groupBy("item").agg(F.max_by(F.struct("decision", "reviewer_kind", "commit", "merge_reference"), "review_no").alias("r"))
    c = computed.select("item", F.struct("content").alias("_c"))
    j = items.join(r, "item", "left").join(c, "item", "left")
    proof = F.col("r.commit").rlike("^([0-9a-f]{40}|[0-9a-f]{64})$") & F.col("r.merge_reference").isNotNull() & (F.col("r.reviewer_kind") == "HUMAN")
    status = F.when((F.col("r.decision") == "ACCEPT") & proof, "ACCEPTED").when(F.col("r.decision") == "REJECT", "REJECTED").otherwise("PENDING")
    return j.select("item", status.alias("status"), F.struct("content").eqNullSafe(F.col("_c")).alias("pinned"))


def blob_id(content: Column) -> Column:
    """The id that git gives to a file of these bytes."""
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.length(content).cast("string")), "UTF-8"), F.unhex(F.lit("00")), content))


def json_walk(df: DataFrame, key: str, body: str) -> DataFrame:
    """(key, pointer, parent, member, kind, value) of every value of a JSON text, RFC 6901 pointers; one round a level."""
    from ..storage import cut

    level = df.select(F.col(key).alias("_k"), F.lit("").alias("pointer"), F.lit(None).cast("string").alias("parent"), F.lit(None).cast("string").alias("member"), F.try_parse_json(body).alias("_v")).where("_v IS NOT NULL")
    out = None
    while out is None or not level.isEmpty():
        level = cut(level.withColumn("kind", F.expr("CASE WHEN is_variant_null(_v) THEN 'null' WHEN schema_of_variant(_v) LIKE 'OBJECT%' THEN 'object' WHEN schema_of_variant(_v) LIKE 'ARRAY%' THEN 'array' WHEN schema_of_variant(_v) = 'STRING' THEN 'string' WHEN schema_of_variant(_v) = 'BOOLEAN' THEN 'boolean' ELSE 'number' END")))
        text = F.when(F.col("kind") == "string", F.try_variant_get("_v", "$", "string")).when(F.col("kind").isin("number", "boolean"), F.to_json("_v"))
        rows = level.select("_k", "pointer", "parent", "member", "kind", text.alias("value"))
        out = rows if out is None else out.unionByName(rows)
        escaped = F.replace(F.replace("_m", F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        a = level.where("kind = 'object'").select("_k", F.col("pointer").alias("_p"), F.explode(F.try_variant_get("_v", "$", "map<string,variant>")).alias("_m", "_v"))
        b = level.where("kind = 'array'").select("_k", F.col("pointer").alias("_p"), F.posexplode(F.try_variant_get("_v", "$", "array<variant>")).alias("_m", "_v")).withColumn("_m", F.col("_m").cast("string"))
        # a null inside a container is a value too
        both = a.unionByName(b.select(a.columns)).withColumn("_v", F.coalesce("_v", F.parse_json(F.lit("null"))))
        level = both.select("_k", F.concat("_p", F.lit("/"), escaped).alias("pointer"), F.col("_p").alias("parent"), F.col("_m").alias("member"), "_v")
    return out.withColumnRenamed("_k", key)


def attachment_plan(files: DataFrame, parsed: DataFrame, revision: str, most: int = 67_108_864, formats: tuple[str, ...] = ("pdf", "hwp", "hwpx"), roles: tuple[str, ...] = ("A", "C")) -> DataFrame:
    """Files (batch_no, posting, ordinal, role, format, http_status, byte_length, sha256) with ``action``: of one posting and ordinal the file of the last batch counts.

    SUPERSEDED, WRONG_ROLE, UNSUPPORTED_FORMAT, NOT_ARCHIVED, EMPTY, TOO_LARGE, REUSE (``parse_id``: the newest good parse (sha256, parser_revision, state, failed_members, finished_at, parse_id) of the same bytes and parser), PARSE.
    """
    w = Window.partitionBy("posting", "ordinal").orderBy(F.desc("batch_no"))
    good = parsed.where((F.col("parser_revision") == revision) & (F.col("state") == "PARSED") & (F.col("failed_members") == 0)).groupBy("sha256").agg(F.max_by("parse_id", F.struct("finished_at", "parse_id")).alias("parse_id"))
    d = files.withColumn("_r", F.row_number().over(w)).join(good, "sha256", "left")
    action = (
        F.when(F.col("_r") > 1, "SUPERSEDED").when(~F.coalesce(F.col("role").isin(*roles), F.lit(False)), "WRONG_ROLE").when(~F.coalesce(F.lower("format").isin(*formats), F.lit(False)), "UNSUPPORTED_FORMAT").when(~F.col("http_status").eqNullSafe(F.lit(200)), "NOT_ARCHIVED")
        .when(F.coalesce("byte_length", F.lit(0)) < 1, "EMPTY").when(F.col("byte_length") > most, "TOO_LARGE").when(F.col("parse_id").isNotNull(), "REUSE").otherwise("PARSE")
    )
    return d.select(*files.columns, action.alias("action"), F.when(action == "REUSE", F.col("parse_id")).alias("parse_id"))


def input_bundle(sections: DataFrame, key: list[str]) -> DataFrame:
    """(key, text, sections, bundle_hash): sections (key, n, text) joined by line ends, in order, with where each begins; the hash is of the whole value."""
    a = sections.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("n", "text"))).alias("_s"))
    text = F.array_join(F.transform("_s", lambda x: x["text"]), "\n")
    first = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<n:int,start:int,stop:int>>").alias("out"))
    step = lambda acc, x: F.struct((acc["end"] + F.length(x["text"]) + 1).cast("int").alias("end"), F.concat(acc["out"], F.array(F.struct(x["n"].cast("int").alias("n"), acc["end"].alias("start"), (acc["end"] + F.length(x["text"])).cast("int").alias("stop")))).alias("out"))
    d = a.select(*key, text.alias("text"), F.aggregate("_s", first, step, lambda acc: acc["out"]).alias("sections"))
    return d.withColumn("bundle_hash", F.sha2(F.to_json(F.struct(*key, "text", "sections")), 256))


#: What a shape can ask of a property: least and most values, a pattern of the text, the kind of the node that it names.
def shape_issues(nodes: DataFrame, properties: DataFrame, shapes: list[dict]) -> DataFrame:
    """(node_id, path, issue) of nodes (node_id, label) whose properties (node_id, path, value) break a shape {label, path, least, most, pattern, of}: MIN_COUNT, MAX_COUNT, PATTERN, WRONG_KIND."""
    labels = nodes.select(F.col("node_id").alias("value"), F.col("label").alias("_l"))
    out = []
    for s in shapes:
        own = nodes.where(F.col("label") == s["label"]).select("node_id")
        p = properties.where(F.col("path") == s["path"])
        n = own.join(p.groupBy("node_id").agg(F.count("*").alias("_n")), "node_id", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
        bad = lambda d, issue: d.select("node_id", F.lit(s["path"]).alias("path"), F.lit(issue).alias("issue"))  # noqa: E731, B023
        if s.get("least"):
            out.append(bad(n.where(F.col("_n") < s["least"]), "MIN_COUNT"))
        if s.get("most") is not None:
            out.append(bad(n.where(F.col("_n") > s["most"]), "MAX_COUNT"))
        values = p.join(own, "node_id", "left_semi")
        if s.get("pattern"):
            out.append(bad(values.where(~F.col("value").rlike(s["pattern"])), "PATTERN"))
        if s.get("of"):
            out.append(bad(values.join(labels, "value", "left").where(~F.col("_l").eqNullSafe(F.lit(s["of"]))), "WRONG_KIND"))
    return reduce(DataFrame.unionByName, out)


# --- review packets ---


def export_packets(items: DataFrame, path: str, key: str, size: int = 100) -> None:
    """Items as JSON lines in ``packet=<n>`` folders of ``size`` each, every line with the hash of its content, so that an answer can be held against what was asked."""
    from ..functions.records import ordinals

    body = F.to_json(F.struct(*items.columns), {"ignoreNullFields": "false"})
    d = ordinals(items.withColumns({"body": body, "content_hash": F.sha2(body, 256)}), [key], "_n", 0)
    d.select(F.floor(F.col("_n") / size).cast("int").alias("packet"), F.col(key).cast("string").alias("key"), "content_hash", "body").write.partitionBy("packet").mode("errorifexists").json(path)


def import_answers(spark, path: str, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers (key, content_hash, decision, reviewer) of exactly what was asked, the others with ``issue``): NOT_ASKED, CONTENT_CHANGED, INVALID_DECISION, ANSWERED_TWICE (with different decisions)."""
    asked = spark.read.schema("key string, content_hash string, body string, packet int").json(path).select("key", F.col("content_hash").alias("_h"))
    twice = answers.groupBy("key", "reviewer").agg(F.count_distinct("decision").alias("_n"))
    d = answers.dropDuplicates().join(asked, "key", "left").join(twice, ["key", "reviewer"], "left")
    issue = F.when(F.col("_h").isNull(), "NOT_ASKED").when(~F.col("content_hash").eqNullSafe(F.col("_h")), "CONTENT_CHANGED").when(~F.coalesce(F.col("decision").isin("ACCEPT", "REJECT", "NOTE"), F.lit(False)), "INVALID_DECISION").when(F.col("_n") > 1, "ANSWERED_TWICE")
    d = d.withColumn("issue", issue)
    return d.where("issue IS NULL").select(answers.columns), d.where("issue IS NOT NULL").select(*answers.columns, "issue")
