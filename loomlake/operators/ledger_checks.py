"""Validation of an ingestion ledger: one bag of (run_id, issue, location), a branch for each rule.

A ledger is a dict of tables: ``runs`` (run_id, source_id, mode, state), ``dependencies`` (run_id, input_source_id, input_run_id), ``partitions`` (run_id, partition_id, kind, page_size,
expected_total), ``documents`` (run_id, document_id, partition_id, page_no, confirmation_no, transport, http_status, provider_result, byte_length, verified, item_count, effective_page, effective_page_size,
declared_total, selected), ``records`` (run_id, document_id, locator, source_record_id, kind, facts: map<string,string>) and ``rejected`` (run_id, document_id, locator). A run without issues is complete.

Defined results: only selected documents count; unknown values break the rules that need them; the order of the bag is undefined and equal rows stay.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rules:
    """What holds for a source's runs.

    ``partition``: of a record's facts, the partition that it must be in, null for any; ``forms``: representations of a posting, each once; ``optional_forms``: those that only an ongoing one has;
    ``pair_facts``: what list and detail must agree on; ``soft_facts``: what they must agree on where the detail tells it.
    """

    depends_on: str | None = None
    kind: str | None = None
    results: tuple[str, ...] = ()
    partition: object = None
    forms: tuple[str, ...] = ()
    optional_forms: tuple[str, ...] = ()
    pair_facts: tuple[str, ...] = ()
    soft_facts: tuple[str, ...] = ()


def issues(ledger: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    runs, parts, docs, records, rejected = (ledger[n] for n in ("runs", "partitions", "documents", "records", "rejected"))
    source = runs.select("run_id", "source_id")
    bag: list[DataFrame] = []

    def add(issue: str, rows: DataFrame, location: Column) -> None:
        bag.append(rows.select("run_id", F.lit(issue).alias("issue"), location.cast("string").alias("location")))

    def of(name: str, default=None) -> Column:
        """A rule's value for a row's source."""
        told = {s: getattr(r, name) for s, r in rules.items() if getattr(r, name)}
        return F.coalesce(*[F.when(F.col("source_id") == s, F.lit(v)) for s, v in told.items()], F.lit(default).cast("string")) if told else F.lit(default).cast("string")

    no = lambda c: ~F.coalesce(c, F.lit(False))
    add("SMOKE_NOT_FULL", runs.where("mode = 'SMOKE'"), F.lit(""))
    add("NO_PARTITIONS", runs.join(parts.select("run_id"), "run_id", "left_anti"), F.lit(""))
    needed = runs.select(F.col("run_id").alias("input_run_id"), F.col("source_id").alias("_s"), F.col("state").alias("_st"), F.col("mode").alias("_m"))
    deps = ledger["dependencies"].join(needed, "input_run_id")
    add("DEPENDENCY_NOT_READY_OR_WRONG_SOURCE", deps.where((F.col("_st") != "READY") | (F.col("_m") == "SMOKE") | (F.col("_s") != F.col("input_source_id"))), F.col("input_source_id"))
    wanted = runs.withColumn("input_source_id", of("depends_on")).where("input_source_id IS NOT NULL")
    add("MISSING_DEPENDENCY", wanted.join(ledger["dependencies"].select("run_id", "input_source_id"), ["run_id", "input_source_id"], "left_anti"), F.col("source_id"))

    d = docs.where("selected")
    count = d.groupBy("run_id", "partition_id").agg(F.count("*").alias("_n"), F.min("page_no").alias("_low"), F.max("page_no").alias("_high"))
    p = parts.join(count, ["run_id", "partition_id"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    pages = F.ceil(F.col("expected_total") / F.col("page_size"))
    paged = (F.col("_n") == F.when(F.col("expected_total") == 0, 2).otherwise(pages)) & (F.col("_low") == 1) & (F.col("_high") == F.greatest(F.lit(1), pages))
    single = (F.col("_n") == 1) & (F.col("_low") == 1) & (F.col("_high") == 1)
    add("PARTITION_INCOMPLETE", p.where(F.col("expected_total").isNull() | no(F.when(F.col("kind") == "PAGED", paged).otherwise(single))), F.col("partition_id"))

    x = d.join(parts.select("run_id", "partition_id", F.col("kind").alias("_kind"), "page_size", "expected_total"), ["run_id", "partition_id"]).join(source, "run_id")
    total, size, items = F.col("expected_total"), F.col("page_size"), F.col("item_count")
    local = F.coalesce("transport", F.lit("HTTP")) == "LOCAL_FILE"
    transport = F.when(local, F.col("http_status").isNull() & F.col("provider_result").isNull()).otherwise(F.col("http_status") == 200)
    body = (F.col("byte_length") > 0) & F.col("verified") & items.isNotNull() & (F.col("effective_page") == F.col("page_no"))
    as_paged = F.col("declared_total").eqNullSafe(total) & F.col("effective_page_size").eqNullSafe(size) & (items == F.greatest(F.lit(0), F.least(size, total - (F.col("page_no") - 1) * size))) & F.when(total > 0, F.col("confirmation_no") == 0).otherwise(F.col("page_no") == 1)
    one = (items == 1) & (F.col("confirmation_no") == 0)
    file = (items == total) & (items > 0) & (F.col("confirmation_no") == 0)
    shape = F.when(F.col("_kind") == "PAGED", as_paged).when(F.col("_kind") == "DETAIL", one).when(F.col("_kind") == "FILE", file).otherwise(True)
    answered = reduce(lambda c, kv: F.when(F.col("source_id") == kv[0], F.col("provider_result").isin(*kv[1].results)).otherwise(c), [(s, r) for s, r in rules.items() if r.results], F.lit(True))
    add("DOCUMENT_NOT_VERIFIED", x.where(no(transport) | no(body) | no(shape) | no(answered)), F.col("document_id"))

    key = ["run_id", "document_id"]
    rows = records.select(*key).unionByName(rejected.select(*key)).groupBy(*key).agg(F.count("*").alias("_rows"))
    add("ROW_COUNT_MISMATCH", d.join(rows, key, "left").where(~items.eqNullSafe(F.coalesce("_rows", F.lit(0)))), F.col("document_id"))
    add("REJECTED_ROW", rejected.join(d.select(*key), key, "left_semi"), F.concat_ws(":", "document_id", "locator"))

    f = records.join(d.select(*key, "partition_id"), key).join(source, "run_id")
    place = F.concat_ws(":", "document_id", "locator")
    add("DUPLICATE_SOURCE_ID", f.groupBy("run_id", "source_record_id").count().where("count > 1"), F.col("source_record_id"))
    add("WRONG_RECORD_KIND", f.where(~F.col("kind").eqNullSafe(of("kind"))), place)
    expected = F.coalesce(*[F.when(F.col("source_id") == s, r.partition(F.col("facts"))) for s, r in rules.items() if r.partition], F.lit(None).cast("string"))
    add("PARTITION_IDENTITY_MISMATCH", f.withColumn("_at", expected).where("_at IS NOT NULL AND _at <> partition_id"), place)

    fact = lambda n: F.try_element_at("facts", F.lit(n))
    for s, r in rules.items():
        if not r.forms:
            continue
        own = f.where(F.col("source_id") == s).withColumns({"_id": fact("posting_id"), "_form": fact("representation")})
        forms = own.groupBy("run_id", "_id").agg(*[F.count_if(F.col("_form") == n).alias(f"n_{n}") for n in (*r.forms, *r.optional_forms)], F.count_if((F.col("_form") == r.forms[0]) & (fact("ongoing") == "true")).alias("_on"))
        bad = reduce(lambda a, b: a | b, [F.col(f"n_{n}") != 1 for n in r.forms])
        for n in r.optional_forms:
            bad = bad | (F.col(f"n_{n}") != F.when(F.col("_on") == 1, 1).otherwise(0))
        add("POSTING_FORMS_MISSING_OR_REPEATED", forms.where(bad), F.col("_id"))
        if r.pair_facts or r.soft_facts:
            side = lambda n: own.where(F.col("_form") == n).select("run_id", "_id", F.col("facts").alias(f"_{n}"))  # noqa: E731, B023
            j = side("list").join(side("detail"), ["run_id", "_id"])
            a, b = (lambda n: F.try_element_at("_list", F.lit(n))), (lambda n: F.try_element_at("_detail", F.lit(n)))
            differs = [~a(n).eqNullSafe(b(n)) for n in r.pair_facts] + [F.nullif(b(n), F.lit("")).isNotNull() & ~a(n).eqNullSafe(b(n)) for n in r.soft_facts]
            add("POSTING_PAIR_CONFLICT", j.where(reduce(lambda p, q: p | q, differs)), F.col("_id"))
    return reduce(DataFrame.unionByName, bag)


def changed_runs(runs: DataFrame) -> DataFrame:
    """(run_id, change) for runs (source_id, run_id, created_at, content_hash, normalized_hash): FIRST, SAME, PARSED_ANEW (equal content, other normalization) or CHANGED, against the source's run before."""
    from pyspark.sql import Window

    w = Window.partitionBy("source_id").orderBy("created_at", "run_id")
    c, n = F.lag("content_hash").over(w), F.lag("normalized_hash").over(w)
    first = F.row_number().over(w) == 1
    change = F.when(first, "FIRST").when(~c.eqNullSafe(F.col("content_hash")), "CHANGED").when(~n.eqNullSafe(F.col("normalized_hash")), "PARSED_ANEW").otherwise("SAME")
    return runs.select("run_id", change.alias("change"))


def refresh_order(sources: DataFrame, runs: DataFrame, failures: DataFrame, exports: DataFrame, dependencies: DataFrame, now: str) -> DataFrame:
    """(source_id, reason) of enabled sources that are due: NEVER, INTERVAL, NOT_EXPORTED or UPSTREAM_NEWER, without a failure in the retry window (doubled for each failure since the last run, up to ``most_seconds``) and with a run of all
    sources that they depend on.

    ``sources``: (source_id, enabled, interval_seconds, retry_seconds, most_seconds); ``runs``: READY (source_id, run_id, created_at); ``failures``: (source_id, failed_at); ``exports``: (run_id); ``dependencies``: (source_id, input_source_id).
    """
    t = F.unix_timestamp(F.lit(now).cast("timestamp"))
    last = runs.groupBy("source_id").agg(F.max_by(F.struct("run_id", "created_at"), F.struct("created_at", "run_id")).alias("l"))
    bad = failures.join(last, "source_id", "left").where("l IS NULL OR failed_at > l.created_at").groupBy("source_id").agg(F.max("failed_at").alias("failed_at"), F.count("*").alias("attempts"))
    out = exports.select(F.col("run_id").alias("_run"), F.lit(True).alias("exported")).distinct()
    up = dependencies.join(last.select(F.col("source_id").alias("input_source_id"), F.col("l.created_at").alias("_at")), "input_source_id", "left").groupBy("source_id").agg(F.bool_or(F.col("_at").isNull()).alias("lacking"), F.max("_at").alias("newest"))
    s = sources.where("enabled").join(last, "source_id", "left").join(bad, "source_id", "left").join(up, "source_id", "left").join(out, F.col("l.run_id") == F.col("_run"), "left")
    reason = F.when(F.col("l").isNull(), "NEVER").when(t - F.unix_timestamp("l.created_at") > F.col("interval_seconds"), "INTERVAL").when(F.col("exported").isNull(), "NOT_EXPORTED").when(F.col("newest") > F.col("l.created_at"), "UPSTREAM_NEWER")
    wait = F.least(F.col("retry_seconds") * F.pow(F.lit(2), F.least(F.col("attempts") - 1, F.lit(20))), F.col("most_seconds"))
    blocked = F.coalesce(t - F.unix_timestamp("failed_at") < wait, F.lit(False)) | F.coalesce("lacking", F.lit(False))
    return s.withColumn("reason", reason).where(F.col("reason").isNotNull() & ~blocked).select("source_id", "reason")


def source_telemetry(runs: DataFrame, now: str, hours: int = 24) -> DataFrame:
    """(source_id, latest, latest_state, accepted, runs, failures) for runs (source_id, run_id, created_at, state): the newest run, the newest READY one, failures of the last hours."""
    by = F.struct("created_at", "run_id")
    recent = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("created_at") < hours * 3600
    return runs.groupBy("source_id").agg(
        F.max_by("run_id", by).alias("latest"), F.max_by("state", by).alias("latest_state"), F.max_by("run_id", F.when(F.col("state") == "READY", by)).alias("accepted"), F.count("*").alias("runs"), F.count_if((F.col("state") == "FAILED") & recent).alias("failures")
    )


def graph_telemetry(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, name, n): nodes by label, edges by predicate, and the totals."""
    a = nodes.select(F.lit("label").alias("part"), F.explode("labels").alias("name")).groupBy("part", "name").agg(F.count("*").alias("n"))
    b = edges.groupBy(F.lit("predicate").alias("part"), F.col("predicate").alias("name")).agg(F.count("*").alias("n"))
    c = nodes.agg(F.count("*").alias("n")).select(F.lit("total").alias("part"), F.lit("nodes").alias("name"), "n")
    e = edges.agg(F.count("*").alias("n")).select(F.lit("total").alias("part"), F.lit("edges").alias("name"), "n")
    return reduce(DataFrame.unionByName, [a, b, c, e])
