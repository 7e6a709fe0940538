"""Status ladders of reviewed work: duplicate groups, profiles, requirements, links, selections; validators; release reads; coverage reports.

A ladder's first matching step counts and unknown conditions don't match. Decisions are read at a cut-off: of each proposal the latest one. Every item has a row, also
one without proposals or decisions.
"""

from __future__ import annotations

import base64
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cohort import ladder
from .ledger import as_of


def decided(items: DataFrame, proposals: DataFrame, decisions: DataFrame, key: str, proposal_cutoff: int, decision_cutoff: int) -> DataFrame:
    """Items with ``p`` (their latest proposal's columns) and ``d`` (its latest decision's), null where there is none.

    Decisions of the proposer's own are none.
    """
    p = as_of(proposals, [key], ["proposal_no"], "proposal_no", proposal_cutoff)
    own = decisions.join(proposals.select("proposal_id", F.col("proposer").alias("_by")).distinct(), "proposal_id", "left").where("_by IS NULL OR reviewer <> _by")
    d = as_of(own.select(decisions.columns), ["proposal_id"], ["decision_id"], "decision_id", decision_cutoff)
    p = p.join(d.select("proposal_id", F.struct(*[c for c in d.columns if c != "proposal_id"]).alias("d")), "proposal_id", "left")
    return items.join(p.select(key, F.struct(*[c for c in p.columns if c not in (key, "d")]).alias("p"), "d"), key, "left")


def proposal_issues(proposals: DataFrame, key: str) -> DataFrame:
    """(proposal_id, issue): a proposal whose parent isn't the latest one of its key before it."""
    w = Window.partitionBy(key).orderBy("proposal_no")
    before = F.lag("proposal_id").over(w)
    return proposals.withColumn("_before", before).where(~F.col("parent_id").eqNullSafe(F.col("_before"))).select("proposal_id", F.lit("PARENT_NOT_LATEST").alias("issue"))


def duplicate_groups(members: DataFrame, proposals: DataFrame, decisions: DataFrame, release: DataFrame, proposal_cutoff: int, decision_cutoff: int) -> DataFrame:
    """(cluster, status) for members (cluster, entity, revision), proposals (cluster, ...) and a release (entity, revision).

    MEMBER_OUTSIDE_RELEASE, SOURCE_CHANGED (a member's revision isn't the release's), REJECTED, ACCEPTED, PENDING.
    """
    r = release.select("entity", F.col("revision").alias("_r"), F.lit(True).alias("_in"))
    state = members.join(r, "entity", "left").groupBy("cluster").agg(F.bool_or(F.col("_in").isNull()).alias("_out"), F.bool_or(~F.col("revision").eqNullSafe(F.col("_r"))).alias("_changed"))
    d = decided(state, proposals, decisions, "cluster", proposal_cutoff, decision_cutoff)
    status = ladder(("MEMBER_OUTSIDE_RELEASE", F.col("_out")), ("SOURCE_CHANGED", F.col("_changed")), ("REJECTED", F.col("d.decision") == "REJECT"), ("ACCEPTED", F.col("d.decision") == "ACCEPT"), default="PENDING")
    return d.select("cluster", status.alias("status"))


def group_ids(entities: DataFrame, members: DataFrame, status: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((entity, group_id): ``duplicate/<cluster>`` of an accepted cluster, else ``posting/<entity>``; entities that two accepted clusters have)."""
    a = members.join(status.where("status = 'ACCEPTED'"), "cluster").select("entity", "cluster")
    several = a.groupBy("entity").agg(F.count_distinct("cluster").alias("clusters")).where("clusters > 1")
    one = a.groupBy("entity").agg(F.min("cluster").alias("cluster"))
    return entities.select("entity").join(one, "entity", "left").select("entity", F.coalesce(F.concat(F.lit("duplicate/"), "cluster"), F.concat(F.lit("posting/"), "entity")).alias("group_id")), several


def profile_status(items: DataFrame, proposals: DataFrame, decisions: DataFrame, proposal_cutoff: int, decision_cutoff: int) -> DataFrame:
    """(key, status) for items (key, extraction_accepted, binding) and proposals with ``binding`` and ``disposition``."""
    d = decided(items, proposals, decisions, "key", proposal_cutoff, decision_cutoff)
    decision = F.col("d.decision")
    status = ladder(
        ("EXTRACTION_NOT_ACCEPTED", ~F.coalesce("extraction_accepted", F.lit(False))), ("NOT_PROPOSED", F.col("p").isNull()), ("SOURCE_CHANGED", ~F.col("binding").eqNullSafe(F.col("p.binding"))), ("REJECTED", decision == "REJECT"),
        ("UNRESOLVED", F.col("p.disposition") == "UNRESOLVED"), ("REVIEWED", decision == "ACCEPT"), default="PENDING",
    )
    return d.select("key", status.alias("status"))


#: Steps of other ladders over (p, d) and the item's columns; the last name is the default.
def requirement_status(d: DataFrame) -> Column:
    decision = F.col("d.decision")
    return ladder(("NOT_PROPOSED", F.col("p").isNull()), ("TARGET_REVISION_MISMATCH", ~F.col("revision").eqNullSafe(F.col("p.revision"))), ("REJECTED", decision == "REJECT"), ("UNRESOLVED", F.col("p.disposition") == "UNRESOLVED"), ("REVIEWED", decision == "ACCEPT"), default="PENDING")


def occupation_status(d: DataFrame) -> Column:
    decision = F.col("d.decision")
    return ladder(
        ("EXTRACTION_NOT_ACCEPTED", ~F.coalesce("extraction_accepted", F.lit(False))), ("NOT_PROPOSED", F.col("p").isNull()), ("SOURCE_CHANGED", ~F.col("binding").eqNullSafe(F.col("p.binding"))), ("CATALOGUE_CHANGED", ~F.col("catalogue").eqNullSafe(F.col("p.catalogue"))),
        ("PENDING", F.col("d").isNull() | ~decision.isin("ACCEPT", "REJECT")), ("REJECTED", decision == "REJECT"), ("MATCHED", F.col("p.disposition") == "MATCHED"), default="UNRESOLVED",
    )


def track_reasons(t: DataFrame) -> Column:
    """Sorted reasons why a track of a posting isn't eligible; an unknown condition counts as not eligible.

    Columns: country, mixed_country, reviewed_domestic, scope_resolved, experience, posting_label, maximum_months, mixed_experience, reviewed_entry.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    entry = F.array(*map(F.lit, ("ENTRY", "INTERNSHIP", "UNRESTRICTED")))
    eligible = yes(F.array_contains(entry, F.col("experience"))) | yes((F.col("experience") == "UNKNOWN") & F.col("posting_label").isin("ENTRY", "INTERNSHIP")) | yes(F.col("maximum_months") <= 24) | yes(F.col("mixed_experience") & F.col("reviewed_entry"))
    steps = {
        "COUNTRY_UNKNOWN": F.col("country").isNull(), "OUTSIDE_COUNTRY": F.col("country") != "KR", "MIXED_COUNTRY_SCOPE_REQUIRES_REVIEW": yes(F.col("mixed_country")) & ~yes(F.col("reviewed_domestic")), "REQUIREMENT_SCOPE_UNRESOLVED": ~yes(F.col("scope_resolved")),
        "MIXED_EXPERIENCE_SCOPE_REQUIRES_REVIEW": yes(F.col("mixed_experience")) & ~yes(F.col("reviewed_entry")), "EXPERIENCE_NOT_ENTRY_ELIGIBLE": ~eligible,
    }
    return F.array_sort(F.array_compact(F.array(*[F.when(c, n) for n, c in steps.items()])))


def linking_status(items: DataFrame, revisions: DataFrame, attempts: DataFrame, links: DataFrame, results: DataFrame) -> DataFrame:
    """(item, outcome): how far each item's extraction and linking have come, one of eleven outcomes.

    ``items``: (item, prepared, source_hash); ``revisions``: (item, source_hash, revision_no, decision, duties, duties_status); ``attempts``: (item, source_hash,
    created_at, attempt, state); ``links``: (item, revision_no, link, decision) with each link's latest decision, null if none; ``results``: (item, revision_no, outcome).
    Work on another source hash doesn't count.
    """
    same = ["item", "source_hash"]
    r = revisions.groupBy(*same).agg(F.max_by(F.struct("revision_no", "decision", "duties", "duties_status"), "revision_no").alias("r"))
    a = attempts.groupBy(*same).agg(F.max_by("state", F.struct("created_at", "attempt")).alias("state"))
    n = links.groupBy("item", "revision_no").agg(F.count_if(F.col("decision") == "ACCEPT").alias("accepted"), F.count_if(F.col("decision").isNull()).alias("open"), F.count("*").alias("links"))
    e = results.where(F.col("outcome").isin("NO_SUPPORTED_MATCH", "NO_RETRIEVAL_CANDIDATES")).select("item", "revision_no", F.lit(True).alias("none")).distinct()
    d = items.join(r, same, "left").join(a, same, "left").withColumn("revision_no", F.col("r.revision_no")).join(n, ["item", "revision_no"], "left").join(e, ["item", "revision_no"], "left")
    outcome = ladder(
        ("INPUT_NOT_PREPARED", ~F.coalesce("prepared", F.lit(False))), ("EXTRACTION_FAILED", F.col("r").isNull() & F.col("state").isin("REJECTED", "ERROR", "BUDGET_BLOCKED")), ("EXTRACTION_REVIEW", F.col("r").isNull() & (F.col("state") == "VALIDATED")), ("PENDING_EXTRACTION", F.col("r").isNull()),
        ("EXTRACTION_REVIEW", ~F.col("r.decision").eqNullSafe(F.lit("ACCEPT"))), ("ATTACHMENT_TEXT_MISSING", F.col("r.duties_status") == "attachment_required"), ("NO_EXPLICIT_DUTIES", F.coalesce("r.duties", F.lit(0)) == 0), ("ACCEPTED_LINKS", F.col("accepted") > 0),
        ("LINK_REVIEW", F.col("open") > 0), ("NO_ACCEPTED_LINKS", F.col("links") > 0), ("NO_SUPPORTED_MATCH", F.col("none")), default="PENDING_CATEGORIZATION",
    )
    return d.select("item", outcome.alias("outcome"))


def changed_inputs(now: DataFrame, done: DataFrame, key: str, content: str) -> DataFrame:
    """(key, change): NEW, CHANGED or GONE inputs since the work that was done; unchanged ones have no row."""
    a, b = now.select(key, F.struct(content).alias("_a")), done.select(key, F.struct(content).alias("_b"))
    change = F.when(F.col("_b").isNull(), "NEW").when(F.col("_a").isNull(), "GONE").when(F.col("_a") != F.col("_b"), "CHANGED")
    return a.join(b, key, "full").select(key, change.alias("change")).where("change IS NOT NULL")


# --- coverage of a related catalogue ---


def qualification_report(links: DataFrame, run: DataFrame, competencies: DataFrame, partitions: DataFrame, mappings: DataFrame, exam_partitions: DataFrame, sessions: DataFrame) -> DataFrame:
    """(link, code, qualification_status, exam_status, mapped, exams) of each link (link, code).

    ``run``: one row (qualification_run, exam_run, exam_of): the READY runs, null if none, and the qualification run that the exam run was made for. ``competencies``: (code);
    ``partitions``: (code, verified, expected_total); ``mappings``: (code, qualification); ``exam_partitions``: (qualification); ``sessions``: (qualification, year, round).
    Counts of an unmapped link are null, those of a mapped one at least 0.
    """
    m = mappings.groupBy("code").agg(F.count_distinct("qualification").alias("_m"))
    fetched = mappings.join(exam_partitions.select("qualification").distinct(), "qualification", "left_semi").groupBy("code").agg(F.count_distinct("qualification").alias("_f"))
    e = mappings.select("code", "qualification").distinct().join(sessions, "qualification").groupBy("code").agg(F.count("*").alias("_e"))
    d = links.crossJoin(F.broadcast(run.limit(1)))  # one row
    known = competencies.select("code").distinct().withColumn("_known", F.lit(True))
    d = d.join(known, "code", "left").join(partitions.select("code", F.struct("verified", "expected_total").alias("_p")), "code", "left").join(m, "code", "left").join(fetched, "code", "left").join(e, "code", "left")
    has = F.coalesce("_m", F.lit(0)) > 0
    qualification = ladder(
        ("NO_READY_QUALIFICATION_SNAPSHOT", F.col("qualification_run").isNull()), ("UNRESOLVED_IDENTIFIER", F.col("_known").isNull()), ("UNFETCHED_QUALIFICATION_PARTITION", F.col("_p").isNull()), ("QUALIFICATION_PARTITION_NOT_VERIFIED", ~F.coalesce("_p.verified", F.lit(False))),
        ("FETCHED_NO_MAPPING", F.col("_p.expected_total") == 0), ("MAPPING_ROWS_MISSING", ~has), default="HAS_RELATED_QUALIFICATION",
    )
    ready = F.col("exam_run").isNotNull() & F.col("exam_of").eqNullSafe(F.col("qualification_run"))
    exam = ladder(
        ("NO_MAPPING_TO_CHECK", ~has), ("NO_READY_EXAM_SNAPSHOT", F.col("exam_run").isNull()), ("EXAM_SNAPSHOT_FOR_DIFFERENT_QUALIFICATION_RUN", ~ready), ("UNFETCHED_EXAM_PARTITION", F.coalesce("_f", F.lit(0)) < F.col("_m")),
        ("FETCHED_NO_EXAM_SESSION", F.coalesce("_e", F.lit(0)) == 0), default="HAS_EXAM_SESSION",
    )
    return d.select("link", "code", qualification.alias("qualification_status"), exam.alias("exam_status"), F.when(has, F.col("_m")).alias("mapped"), F.when(has, F.when(ready, F.coalesce("_e", F.lit(0))).otherwise(0)).alias("exams"))


def status_coverage(report: DataFrame, category: Column, key: str, status: str, wanted: dict[str, list[str]]) -> DataFrame:
    """(category, links, ...): distinct keys of each category, and of those with a status of each named list."""
    counts = [F.count_distinct(F.when(F.col(status).isin(*v), F.col(key))).alias(n) for n, v in wanted.items()]
    return report.groupBy(category.alias("category")).agg(F.count_distinct(key).alias("links"), *counts)


def revalidation(old: DataFrame, new: DataFrame, key: str, content: list[str]) -> DataFrame:
    """(old_rows, new_rows, missing, added, changed, equal) of two whole catalogues, compared by full content hashes."""
    h = F.sha2(F.to_json(F.struct(*sorted(content)), {"ignoreNullFields": "false"}), 256)
    a, b = old.select(key, h.alias("_a")), new.select(key, h.alias("_b"))
    j = a.join(b, key, "full")
    d = j.agg(F.count("_a").alias("old_rows"), F.count("_b").alias("new_rows"), F.count_if(F.col("_b").isNull()).alias("missing"), F.count_if(F.col("_a").isNull()).alias("added"), F.count_if(F.col("_a") != F.col("_b")).alias("changed"))
    return d.withColumn("equal", (F.col("missing") + F.col("added") + F.col("changed")) == 0)


# --- release reads ---


def release_summary(entities: DataFrame, claims: DataFrame) -> DataFrame:
    """(kind, entities, claims, reviewed, share) of a release: entities (entity, kind), claims (entity, status)."""
    c = claims.groupBy("entity").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "REVIEWED").alias("r"))
    d = entities.join(c, "entity", "left").groupBy("kind").agg(F.count("*").alias("entities"), F.coalesce(F.sum("n"), F.lit(0)).alias("claims"), F.coalesce(F.sum("r"), F.lit(0)).alias("reviewed"))
    return d.withColumn("share", F.round(F.try_divide("reviewed", "claims"), 6))


def entity_page(entities: DataFrame, release: str, size: int, cursor: str | None = None, kind: str | None = None) -> tuple[DataFrame, str]:
    """(page by id, scope): rows after the cursor of the same release and kind, one more than the page; a cursor of another scope is refused."""
    scope = f"{release}/{kind or '*'}"
    d = entities.where(F.col("release_id") == release)
    d = d.where(F.col("kind") == kind) if kind else d
    if cursor is not None:
        got = json.loads(base64.urlsafe_b64decode(cursor))
        if got["scope"] != scope:
            raise ValueError("the cursor belongs to another query")
        d = d.where(F.col("entity") > F.lit(got["last"]))
    return d.orderBy("entity").limit(size + 1), scope


def page_cursor(scope: str, last: str) -> str:
    return base64.urlsafe_b64encode(json.dumps({"scope": scope, "last": last}).encode()).decode()


def entity_details(entities: DataFrame, claims: DataFrame, evidence: DataFrame, samples: int = 5) -> DataFrame:
    """(entity, kind, claims: array of (claim, status, evidence, quotes)): each claim with the number of its spans and its first ``samples`` quotes."""
    w = Window.partitionBy("claim").orderBy("artifact", "start", "quote")
    few = evidence.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= samples).groupBy("claim").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "quote"))), lambda x: x["quote"]).alias("quotes"))
    n = evidence.groupBy("claim").agg(F.count("*").alias("evidence"))
    c = claims.join(n, "claim", "left").join(few, "claim", "left").withColumns({"evidence": F.coalesce("evidence", F.lit(0)), "quotes": F.coalesce("quotes", F.array().cast("array<string>"))})
    own = c.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("claim", "status", "evidence", "quotes"))).alias("claims"))
    return entities.join(own, "entity", "left").select("entity", "kind", F.coalesce("claims", F.array().cast(own.schema["claims"].dataType)).alias("claims"))


# --- requirements ---

#: Kinds of conditions, each with the units or values that it may have: fixed values.
CONDITIONS = {"EXPERIENCE": ("MONTH", "YEAR"), "EDUCATION": ("LEVEL",), "CREDENTIAL": ("CODE",), "SKILL": ("CODE",), "LANGUAGE": ("CODE", "LEVEL"), "AGE": ("YEAR",), "RESIDENCE": ("CODE",), "LEGAL": ("CODE",), "OTHER": ("TEXT",)}


def canonical_condition(kind: Column, operator: Column, unit: Column, value: Column) -> Column:
    """JSON text of a condition with its keys in byte order: years become months, values are trimmed, empty ones left out; null for a kind or unit that doesn't exist.

    It is the key under which equal conditions meet.
    """
    months = F.when((kind == "EXPERIENCE") & (unit == "YEAR"), (value.try_cast("int") * 12).cast("string")).otherwise(F.nullif(F.trim(value), F.lit("")))
    own = F.when((kind == "EXPERIENCE") & (unit == "YEAR"), "MONTH").otherwise(unit)
    ok = reduce(lambda a, b: a | b, [(kind == k) & (unit.isNull() | unit.isin(*u)) for k, u in CONDITIONS.items()])
    return F.when(F.coalesce(ok, F.lit(False)), F.to_json(F.struct(kind.alias("kind"), F.coalesce(operator, F.lit("EQ")).alias("operator"), own.alias("unit"), months.alias("value"))))


def normalized_requirements(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((condition_key, condition, requirements, postings) of the distinct conditions, rows without a valid one).

    ``rows``: (requirement, posting, kind, operator, unit, value).
    """
    d = rows.withColumn("condition", canonical_condition(*(F.col(c) for c in ("kind", "operator", "unit", "value"))))
    good = d.where("condition IS NOT NULL").groupBy("condition").agg(F.count_distinct("requirement").alias("requirements"), F.count_distinct("posting").alias("postings"))
    return good.select(F.sha2("condition", 256).alias("condition_key"), "condition", "requirements", "postings"), d.where("condition IS NULL").drop("condition")


def tree_parts(trees: DataFrame, key: str, nodes: str) -> DataFrame:
    """(key, path, op, text, depth) of expression trees given as arrays of nodes (op, text, children: indices); node 0 is the root.

    Walked level by level; a node that is reached twice, or a child that isn't there, makes the tree invalid: one row with the op INVALID.
    """
    from ..storage import cut

    t = trees.select(F.col(key).alias("_k"), F.col(nodes).alias("_n"))
    bad = t.select("_k", F.flatten(F.transform("_n", lambda x: F.coalesce(x["children"], F.array().cast("array<int>")))).alias("c"), F.size("_n").alias("n"))
    bad = bad.where((F.size(F.array_distinct("c")) != F.size("c")) | F.exists("c", lambda x: (x < 1) | (x >= F.col("n"))) | (F.size("c") != F.greatest(F.col("n") - 1, F.lit(0)))).select("_k")
    level = t.join(bad, "_k", "left_anti").where(F.size("_n") > 0).select("_k", "_n", F.lit(0).alias("_at"), F.lit("0").alias("path"), F.lit(0).alias("depth"))
    out, first = None, True
    while first or not level.isEmpty():
        level = cut(level)
        node = F.col("_n")[F.col("_at")]
        rows = level.select("_k", "path", node["op"].alias("op"), node["text"].alias("text"), "depth")
        out = rows if out is None else out.unionByName(rows)
        level = level.select("_k", "_n", "path", "depth", F.posexplode(node["children"]).alias("_i", "_at")).select("_k", "_n", "_at", F.concat_ws("/", "path", "_i").alias("path"), (F.col("depth") + 1).alias("depth"))
        first = False
    invalid = bad.select("_k", F.lit("0").alias("path"), F.lit("INVALID").alias("op"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("depth"))
    return out.unionByName(invalid).withColumnRenamed("_k", key)
