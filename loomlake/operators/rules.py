"""Guards in three-valued logic, citations, accounting of passages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def guard(tree: dict, observations: Column) -> Column:
    """Boolean column of a tree of {"op": AND|OR|NOT|TEST}; an observation that is absent or null is unknown."""
    op = tree["op"]
    if op == "TEST":
        return F.try_element_at(observations, F.lit(tree["name"]))
    parts = [guard(x, observations) for x in tree["children"]]
    if op == "NOT":
        return ~parts[0]
    return reduce((lambda a, b: a & b) if op == "AND" else (lambda a, b: a | b), parts)


def activations(rules: list[dict], observations: Column) -> dict[str, Column]:
    """Three-valued activation of each rule: its guard and none of the active rules that disable it.

    A disabling rule acts only if it is active itself, and an unknown one leaves its target unknown. A rule without a guard
    holds. Rules that disable each other in a circle, and unknown targets, are an error.
    """
    by_id = {r["id"]: r for r in rules}
    if unknown := [r["target"] for r in rules if r.get("action") == "DISABLE" and r["target"] not in by_id]:
        raise ValueError(f"unknown target: {unknown[0]}")
    done: dict[str, Column] = {}

    def active(i: str, above: tuple[str, ...]) -> Column:
        if i in above:
            raise ValueError("rules disable each other in a circle")
        if i not in done:
            out = guard(by_id[i]["guard"], observations) if by_id[i].get("guard") else F.lit(True)
            for r in rules:
                if r.get("action") == "DISABLE" and r["target"] == i:
                    out = out & ~active(r["id"], (*above, i))
            done[i] = out
        return done[i]

    for i in by_id:
        active(i, ())
    return done


def evaluate_rules(cases: DataFrame, case_id: str, observations: str, rules: list[dict]) -> DataFrame:
    """(case_id, rule_id, state): APPLIES, NOT, UNKNOWN, or DISABLED where an active rule disables it."""
    states = activations(rules, F.col(observations))
    off = {i: [states[r["id"]] for r in rules if r.get("action") == "DISABLE" and r["target"] == i] for i in states}
    said = lambda c: F.when(c, "APPLIES").when(~c, "NOT").otherwise("UNKNOWN")
    disabled = lambda i: F.coalesce(reduce(lambda a, b: a | b, off[i]), F.lit(False))
    out = [F.struct(F.lit(i).alias("rule_id"), (F.when(disabled(i), "DISABLED").otherwise(said(c)) if off[i] else said(c)).alias("state")) for i, c in states.items()]
    return cases.select(case_id, F.explode(F.array(*out)).alias("r")).select(case_id, "r.rule_id", "r.state")


def citation_issues(answers: DataFrame, answer_id: str, most: int = 2, quotes: int = 6) -> DataFrame:
    """(answer_id, issue) for answers (code array, shortlist array, quotes array<string>, source text)."""
    issues = {
        "TOO_MANY_MATCHES": F.size("codes") > most,
        "REPEATED_CODE": F.size(F.array_distinct("codes")) < F.size("codes"),
        "OUTSIDE_SHORTLIST": F.size(F.array_except("codes", "shortlist")) > 0,
        "QUOTE_COUNT": ~F.size("quotes").between(1, quotes),
        "QUOTE_NOT_IN_SOURCE": ~F.forall("quotes", lambda q: F.contains("source", q)),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in issues.items()]))
    return answers.select(answer_id, F.explode(found).alias("issue"))


def overlapping_spans(spans: DataFrame, key: str, span_id: str, start: str, stop: str) -> DataFrame:
    """(key, span_id): spans that begin before an earlier one of their key has ended; one sort, no pairs."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(start, stop, span_id).rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("_until", F.max(stop).over(w)).where(F.col(start) < F.col("_until")).select(key, span_id)


def range_overlap(left: DataFrame, right: DataFrame, key: str, start: str, stop: str, width: int) -> DataFrame:
    """Pairs of half-open ranges of one key that overlap: each range goes to its cells of ``width``, and a pair is kept in the first cell they share."""
    cells = lambda d, side: d.select(key, F.struct(*[c for c in d.columns if c != key]).alias(side), F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.greatest(F.col(stop) - 1, F.col(start))) / width))).alias("_cell"))
    j = cells(left, "l").join(cells(right, "r"), [key, "_cell"])
    first = F.floor(F.greatest(F.col("l")[start], F.col("r")[start]) / width)
    return j.where((F.col("l")[start] < F.col("r")[stop]) & (F.col("r")[start] < F.col("l")[stop]) & (F.col("_cell") == first)).drop("_cell")
