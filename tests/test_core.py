"""The core operators: every query against its SQL, and sources, sinks, streams and edge cases on small tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomlake.functions import hashing, temporal, text
from loomlake.operators import assembly, cohort, demand, graph, ledger, quality, retrieval, rules
from loomlake.plans import ORACLE_SQL, QUERIES
from loomlake.sources import readers, sinks
from loomlake.streaming import ndjson

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in TABLES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{SF}/{n}.parquet'")
    return con


def rows(found):
    return sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in found)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    d = QUERIES[name](spark, SF)
    columns = sorted(d.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert rows(d.select(*columns).collect()) == rows(want)


def test_entry_contract(spark):
    assert entry.entry(spark).columns == ["posting_id", "status", "priority", "day"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_text_functions(spark):
    d = spark.createDataFrame([("  a　b \n", "20240230", " 12 "), ("", "20240229", "1x"), (None, None, None)], "t string, d string, i string")
    got = d.select(text.source_text(F.col("t")), text.day(F.col("d")).cast("string"), text.source_integer(F.col("i")), text.fold_space(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("a　b", None, 12, "a b"), (None, "2024-02-29", None, ""), (None, None, None, None)]
    assert spark.createDataFrame([("é\r\nx",), (None,)], "t string").select(text.nfc("t")).collect()[0][0] == "é\nx"
    kinds = {"2024-01-02": "DAY", "2024-01-02T00:00:00Z": "DAY", "2024-01-02T00:00:00.000Z": "DAY", "2024-01-02T10:00:00Z": "INSTANT", "2024-01-02T00:00:00+00:00": "INSTANT", "2024-01-02T10:00:00.123+09:00": "INSTANT"}
    kinds |= dict.fromkeys(["x", "2024", "2024-01-02 10:00:00", "2024-02-30", "2024-02-30T10:00:00Z", "2024-01-02T24:00:00Z", "2024-01-02T10:60:00Z", "2024-01-02T10:00:00", "", "2024-01-02\n"], "INVALID") | {None: None}
    k = spark.createDataFrame([(x,) for x in kinds], "t string")
    assert {r["t"]: r["k"] for r in k.select("t", temporal.date_kind(F.col("t")).alias("k")).collect()} == kinds
    n = spark.createDataFrame([("٣٤",), ("１２",), ("१",), ("9" * 19,), ("-1",), ("1.0",), ("²",)], "t string")
    assert [r[0] for r in n.select(text.source_integer(F.col("t"))).collect()] == [34, 12, 1, None, None, None, None]
    assert spark.range(1).select(text.percent_encode(F.lit("a b/é"))).first()[0] == "a%20b%2F%C3%A9"


def test_set_hash_ignores_order_and_repeats(spark):
    a = spark.createDataFrame([(1, x) for x in "abcab"], "k int, v string")
    b = spark.createDataFrame([(1, x) for x in "cba"], "k int, v string").repartition(3)
    assert hashing.set_hash(a, ["k"], "v").collect() == hashing.set_hash(b, ["k"], "v").collect()


def test_page_completeness_cases(spark):
    schema = "k string, page_no int, page_size int, declared_total int, item_count int"
    d = spark.createDataFrame([("ok", 1, 10, 12, 10), ("ok", 2, 10, 12, 2), ("gap", 1, 10, 25, 10), ("gap", 3, 10, 25, 15), ("zero", 1, 10, 0, 0), ("zero", 1, 10, 0, 0), ("once", 1, 10, 0, 0), ("moved", 1, 10, 5, 5), ("moved", 1, 10, 6, 5), ("short", 1, 10, 5, 4)], schema)
    got = {r["k"]: r["reason"] for r in quality.page_completeness(d, ["k"]).collect()}
    assert got == {"ok": None, "gap": "PAGES_MISSING_OR_REPEATED", "zero": None, "once": "EMPTY_NOT_CONFIRMED", "moved": "UNSTABLE_PAGINATION", "short": "PAGE_ROW_COUNT"}
    schema += ", ordinal int, ids array<string>, detail boolean"
    full = [("size", 1, 10, 12, 10, 0, ["a"], False), ("size", 2, 12, 12, 2, 0, ["b"], False), ("uneven", 1, 10, 20, 5, 0, [], False), ("uneven", 2, 10, 20, 15, 0, [], False), ("third", 1, 10, 0, 0, 0, [], False), ("third", 1, 10, 0, 0, 1, [], False), ("third", 1, 10, 0, 0, 2, [], False)]
    full += [("turns", 1, 10, 5, 5, 1, [], False), ("ids", 1, 10, 2, 2, 0, ["x", "x"], False), ("detail", 1, 1, 1, 1, 0, ["d"], True), ("details", 1, 1, 1, 2, 0, ["e", "f"], True), ("ok", 1, 10, 1, 1, 0, ["g"], False), ("late", 2, 10, 0, 0, 0, [], False), ("late", 1, 10, 0, 0, 1, [], False)]
    got = {r["k"]: r["reason"] for r in quality.page_completeness(spark.createDataFrame(full, schema), ["k"], ordinal="ordinal", identities="ids", detail="detail").collect()}
    assert got == {"size": "UNSTABLE_PAGINATION", "uneven": "PAGE_ROW_COUNT", "third": "EMPTY_NOT_CONFIRMED", "turns": "PAGE_ROW_COUNT", "ids": "DUPLICATE_IDENTITY", "detail": None, "details": "DETAIL_COUNT", "ok": None, "late": "EMPTY_NOT_CONFIRMED"}


def test_merge_keeps_the_list_where_detail_is_null(spark):
    d = spark.createDataFrame([(1, "list", 1, "a", "x"), (1, "detail", 2, None, "y"), (2, "list", 3, "b", None)], "k int, representation string, record_id int, f string, g string")
    got = {r["k"]: (r["f"], r["g"], r["origin"], r["n_detail"]) for r in assembly.merge_list_detail(d, ["k"], ["f", "g"]).collect()}
    assert got == {1: ("a", "y", {"f": "list", "g": "detail"}, 1), 2: ("b", None, {"f": "list"}, 0)}


def test_unknown_observations_stay_unknown(spark):
    d = spark.createDataFrame([(1, {"a": True}), (2, {"b": False}), (3, {})], "c int, o map<string,boolean>")
    tree = {"op": "OR", "children": [{"op": "TEST", "name": "a"}, {"op": "NOT", "children": [{"op": "TEST", "name": "b"}]}]}
    got = {r["c"]: r["state"] for r in rules.evaluate_rules(d, "c", "o", [{"id": "r", "guard": tree}]).collect()}
    assert got == {1: "APPLIES", 2: "APPLIES", 3: "UNKNOWN"}


def test_reviewer_is_not_the_proposer(spark):
    p = spark.createDataFrame([("k", 1, 1, "ann")], "key string, proposal_id int, proposal_no int, proposer string")
    d = spark.createDataFrame([(1, 1, "ACCEPT", "ann")], "proposal_id int, decision_id int, decision string, reviewer string")
    assert cohort.review_status(p, d, "key", 9, 9).first()["status"] == "PENDING"
    d = spark.createDataFrame([(1, 1, "ACCEPT", "bob"), (1, 2, "NOTE", "ann")], "proposal_id int, decision_id int, decision string, reviewer string")
    assert cohort.review_status(p, d, "key", 9, 9).first()["status"] == "ACCEPTED"
    assert cohort.review_status(p, d, "key", 9, 0).first()["status"] == "PENDING"


def test_rules_that_disable_rules(spark):
    d = spark.createDataFrame([(1, {"x": True, "y": True}), (2, {"x": True, "y": False}), (3, {"x": None, "y": True}), (4, {"x": False, "y": False})], "c int, o map<string,boolean>")
    off = lambda i, target, name: {"id": i, "action": "DISABLE", "target": target, "guard": {"op": "TEST", "name": name}}
    state = lambda r: {(x["c"], x["rule_id"]): x["state"] for x in rules.evaluate_rules(d, "c", "o", r).collect()}
    two = state([{"id": "r"}, off("p", "r", "x"), off("q", "r", "y")])  # either disabler counts, an unknown one leaves it open
    assert [two[c, "r"] for c in (1, 2, 3, 4)] == ["DISABLED", "DISABLED", "DISABLED", "APPLIES"]
    chain = state([{"id": "r"}, off("p", "r", "x"), off("q", "p", "y")])  # a disabled rule doesn't disable
    assert [chain[c, "r"] for c in (1, 2, 3, 4)] == ["APPLIES", "DISABLED", "APPLIES", "APPLIES"]
    assert state([{"id": "r"}, off("p", "r", "x")])[3, "r"] == "UNKNOWN"
    for bad in ([{"id": "r"}, off("p", "none", "x")], [off("p", "q", "x"), off("q", "p", "y")]):
        with pytest.raises(ValueError):
            rules.evaluate_rules(d, "c", "o", bad)


def test_containment_by_automaton_and_by_grams(spark):
    texts = spark.createDataFrame([(1, "a数据库bb"), (2, None), (None, "bb"), (3, "")], "d int, t string")
    terms = spark.createDataFrame([("x", "数据"), ("y", "b"), ("x", "数据"), ("z", "数据"), ("w", None), ("v", "c")], "i string, w string")
    want = {(1, "x"), (1, "y"), (1, "z")}
    for letters in (retrieval.AUTOMATON_LETTERS, 0):
        got = [tuple(r) for r in retrieval.containment_join(texts, terms, "d", "t", "i", "w", letters=letters).collect()]
        assert set(got) == want and len(got) == 3
    assert retrieval.containment_join(texts, terms.limit(0), "d", "t", "i", "w").count() == 0
    placed = texts.withColumns({"p": F.lit("bb"), "q": F.lit("数据 c")})
    for letters in (retrieval.AUTOMATON_LETTERS, 0):
        got = {tuple(r) for r in retrieval.containment_join(placed, terms, "d", "t", "i", "w", letters=letters, places=[("p", 8.0), ("q", 4.0)]).collect()}
        assert got == {(1, "x", 4.0), (1, "y", 8.0), (1, "z", 4.0)}


def test_containment_of_short_terms_and_no_pairs(spark):
    texts = spark.createDataFrame([(1, "abcdef"), (2, "xyz"), (3, None), (4, "")], "d int, t string")
    terms = spark.createDataFrame([(1, "a"), (2, "cdef"), (3, "zz"), (4, ""), (5, "yz")], "i int, w string")
    assert {tuple(r) for r in retrieval.containment_join(texts, terms, "d", "t", "i", "w").collect()} == {(1, 1), (1, 2), (2, 5)}
    assert {tuple(r) for r in retrieval.containment_by_grams(texts, terms, "d", "t", "i", "w").collect()} == {(1, 1), (1, 2), (2, 5)}
    plan = retrieval.containment_by_grams(texts, terms, "d", "t", "i", "w")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_cursor_is_bound_to_its_query():
    assert demand.read_cursor(demand.cursor("q", "7"), "q") == "7"
    with pytest.raises(ValueError):
        demand.read_cursor(demand.cursor("q", "7"), "r")


def test_json_ld_lines(spark):
    n = graph.nodes(spark.createDataFrame([(1, "a"), (2, None)], "id int, name string"), "THING", F.col("id"), ["name"])
    e = graph.edges(spark.createDataFrame([("thing/1", "thing/2")], "s string, o string"), F.col("s"), "KNOWS", F.col("o"))
    import json

    got = {json.loads(r[0])["@id"]: json.loads(r[0]) for r in sinks.json_ld(n, e, "urn:x/").collect()}
    assert got == {"urn:x/thing/1": {"@id": "urn:x/thing/1", "@type": "THING", "name": "a", "KNOWS": ["urn:x/thing/2"]}, "urn:x/thing/2": {"@id": "urn:x/thing/2", "@type": "THING"}}
    assert graph.dangling(e, n).count() == 0


def test_csv_charsets_and_width(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿이름,값\n가,1\n나,2,3\n".encode())
    (tmp_path / "b.csv").write_bytes("이름,값\n다,\"x\ny\"\n".encode("cp949"))
    (tmp_path / "c.csv").write_bytes(b"other,head\n")
    got = {(r["path"][-5:], r["locator"], r["이름"], r["error_code"]) for r in readers.csv_records(readers.raw_files(spark, str(tmp_path)), ["이름", "값"]).collect()}
    assert got == {("a.csv", "csv:record:1", "가", None), ("a.csv", "csv:record:2", None, "WIDTH"), ("b.csv", "csv:record:1", "다", None), ("c.csv", "csv:header", None, "HEADER")}
    files = readers.raw_files(spark, str(tmp_path))
    assert readers.verified(files, files.limit(2)).count() == 2


def test_json_envelopes_and_rejects(spark):
    from pyspark.sql.types import StructType

    d = spark.createDataFrame([(1, '{"root":{"items":[{"a":1},{"a":2}],"totalCount":2}}'), (2, '{"body":{"items":[],"totalCount":"0"}}'), (3, '{"result":[{"a":3}]}'), (4, "[]")], "i int, body string")
    got = [(r["i"], r["declared_total"], r["error_code"], r["item"] and r["item"]["a"]) for r in readers.json_envelope(d, "body", StructType.fromDDL("a int")).collect()]
    assert sorted(got, key=str) == sorted([(1, 2, None, 1), (1, 2, None, 2), (2, 0, None, None), (3, None, None, 3), (4, None, "ENVELOPE", None)], key=str)
    _, bad = readers.json_rows(spark.createDataFrame([('{"a":1,"a":2}',), ("",), ("[1]",), ('{"a":1}',)], "b string"), "b")
    assert sorted(r["error_code"] for r in bad.collect()) == ["BLANK", "INVALID_JSON", "NOT_AN_OBJECT"]


def test_append_new_is_idempotent(spark, tmp_path):
    d = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, c string")
    path = str(tmp_path / "t")
    assert sinks.append_new(d, path, ["k"], "c") == 2
    assert sinks.append_new(d, path, ["k"], "c") == 0
    with pytest.raises(sinks.Conflict):
        sinks.append_new(spark.createDataFrame([(1, "other")], "k int, c string"), path, ["k"], "c")
    for fresh in (path, str(tmp_path / "new")):  # two contents of a new key
        with pytest.raises(sinks.Conflict):
            sinks.append_new(spark.createDataFrame([(7, "a"), (7, None)], "k int, c string"), fresh, ["k"], "c")
    assert spark.read.parquet(path).count() == 2


def test_ndjson_stream_resumes(spark, tmp_path):
    source, good, bad, mark = (str(tmp_path / n) for n in ("in", "good", "bad", "mark"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.ndjson").write_text('{"a":1}\nnot json\n')
    ndjson.ingest(spark, source, good, bad, mark)
    (tmp_path / "in" / "2.ndjson").write_text('{"a":2}\n')
    ndjson.ingest(spark, source, good, bad, mark)
    ndjson.ingest(spark, source, good, bad, mark)
    assert sorted(r["value"] for r in spark.read.parquet(good).collect()) == ['{"a":1}', '{"a":2}']
    assert spark.read.parquet(bad).count() == 1


def test_latest_by_breaks_ties_by_id(spark):
    d = spark.createDataFrame([("k", 1, 5), ("k", 1, 7), (None, 2, 1)], "k string, at int, id int")
    assert {(r["k"], r["id"]) for r in ledger.latest_by(d, ["k"], ["at", "id"]).collect()} == {("k", 7), (None, 1)}


@pytest.fixture
def late_keys(tmp_path):
    """lineitem and events with keys on both sides of 2000 and 3000."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT 1990 + (i // 4) * 17 AS l_orderkey, i % 4 + 1 AS l_linenumber, i % 7 AS l_suppkey, i * i * 7 % 1000 AS l_partkey FROM range(400) r(i)) TO '{tmp_path}/lineitem.parquet'")
    con.execute(f"COPY (SELECT i AS event_id, i % 7 AS user_id FROM range(600) r(i)) TO '{tmp_path}/events.parquet'")
    read = lambda n, *c: con.execute(f"SELECT {', '.join(c)} FROM '{tmp_path}/{n}.parquet'").fetchall()
    return str(tmp_path), read("lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"), read("events", "event_id", "user_id")


def test_range_overlap_join_has_all_orders(spark, late_keys):
    sf_dir, items, events = late_keys
    want = [(o * 10 + n, e) for o, n, k, p in items for e, u in events if u == k and p % 500 < e % 500 + 5 and e % 500 < p % 500 + n * 3]
    assert any(part >= 20000 for part, _ in want)
    assert rows(QUERIES["range_overlap_join"](spark, sf_dir).collect()) == rows(want)


def test_overlapping_passages_has_all_orders(spark, late_keys):
    sf_dir, items, _ = late_keys
    spans = [(o, n, p % 100, p % 100 + 10) for o, n, _, p in items]
    want = [(o, n) for o, n, a, b in spans if any(x == o and (c, d, m) < (a, b, n) and a < d for x, m, c, d in spans)]
    assert any(o >= 3000 for o, _ in want)
    assert rows(QUERIES["overlapping_passages"](spark, sf_dir).collect()) == rows(want)


@pytest.fixture
def small_corpus(tmp_path):
    """documents and benchmark with short words, words inside longer ones and items of more than 20 words."""
    long = " ".join(f"{a}{b}{c}" for a in "qrst" for b in "aeiou" for c in ("b", "lmn", "xyzuvw"))
    docs = [(1, "Manager\nplans the data", "web"), (2, "other\nmismanagement, of 数据库 things", "book"), (3, "ta\nxx da yy", None), (4, None, "data"), (5, "", "web"), (6, long.upper() + "\nend", "web"), (7, "zz\nqaxyzuvwq selmno", "x"), (8, "é" * 300 + "manage", "x")]
    items = [(1, "manage data"), (2, long), (3, "a of\n数据库管理"), (4, " ".join(["word"] * 120) + " plans")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    for n in ("documents", "benchmark"):
        con.execute(f"COPY {n} TO '{tmp_path}/{n}.parquet'")
    return str(tmp_path), docs, items


def test_ngram_idf_topk_scores_grams_by_location(spark, small_corpus):
    import math
    import re

    sf_dir, docs, items = small_corpus
    terms = {}
    for item, body in items:
        own = {}
        for w in re.split(r"[\W_]+", body.lower()):
            if 2 <= len(w) <= 40:
                own[w] = 1.0
                for n, weight in ((3, 0.65), (2, 0.35)):
                    for i in range(len(w) - n + 1 if len(w) > n else 0):
                        own[w[i : i + n]] = max(own.get(w[i : i + n], 0), weight)
        terms[item] = dict(sorted(own.items(), key=lambda x: (-x[1], -len(x[0]), x[0]))[:480])
    fields = {i: ((b or "").lower().split("\n")[0], (s or "").lower(), (b or "").lower() + " " + (s or "").lower()) for i, b, s in docs}
    df = {x: sum(x in f[2] for f in fields.values()) for own in terms.values() for x in own}
    want = []
    for item, own in terms.items():
        scores = {i: round(sum(w * (8 if x in f[0] else 4 if x in f[1] else 1) * math.log(1 + len(docs) / df[x]) for x, w in own.items() if x in f[2]), 3) for i, f in fields.items() if any(x in f[2] for x in own)}
        want += [(item, i, s, r) for r, (i, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:5], 1)]
    assert (1, 3) in {x[:2] for x in want} and max(map(len, terms.values())) > 20
    assert rows(QUERIES["ngram_idf_topk"](spark, sf_dir).select("item_id", "doc_id", "score", "rank").collect()) == rows(want)


def test_char_ngrams_of_any_script(spark):
    d = spark.createDataFrame([("é数𝒳b",), ("ab",), ("",), (None,)], "w string")
    assert [tuple(r) for r in d.select(text.char_ngrams(F.col("w"), 1), text.char_ngrams(F.col("w"), 3)).collect()] == [(list("é数𝒳b"), ["é数𝒳", "数𝒳b"]), (["a", "b"], []), ([], []), ([], [])]


def test_taxonomy_prefix_tree_has_all_parts(spark, tmp_path):
    duckdb.sql(f"COPY (SELECT i AS p_partkey FROM range(1000) r(i)) TO '{tmp_path}/part.parquet'")
    want = []
    for node in range(1, 1000):
        up, steps = node, 0
        while up > 0:
            up, steps = up // 3, steps + 1
            want.append((node, up, steps))
    assert rows(QUERIES["taxonomy_prefix_tree"](spark, str(tmp_path)).select("node", "ancestor", "steps").collect()) == rows(want)


def test_containment_join_has_every_word(spark, small_corpus):
    sf_dir, docs, items = small_corpus
    want = [(i, item * 1_000_000 + n) for item, body in items for n, w in enumerate(dict.fromkeys(body.split())) for i, b, _ in docs if b and w in b]
    assert (1, 3_000_000) in want and (1, 4_000_001) in want
    assert rows(QUERIES["containment_join"](spark, sf_dir).collect()) == rows(want)


def test_taxonomies_json_and_chains_have_no_depth_bound(spark):
    ring = [(i, i % 20 + 1) for i in range(1, 21)] + [(i, i - 1) for i in range(102, 141)]
    links = spark.createDataFrame(ring, "child long, parent long")
    got = {(r["node"], r["ancestor"]): r["steps"] for r in graph.ancestors(links, "child", "parent").collect()}
    assert got == {(i, j): (j - i - 1) % 20 + 1 for i in range(1, 21) for j in range(1, 21)} | {(i, j): i - j for i in range(102, 141) for j in range(101, i)}
    items = spark.createDataFrame([(i, 2) for i in range(1, 21)], "code long, level int")
    assert {r["code"] for r in graph.taxonomy_issues(items, links).where("issue = 'CYCLE'").collect()} == set(range(1, 21))
    d = spark.createDataFrame([(1, '{"a":{"b":{"c":{"d":{"e":{"f":7}}}}},"x":1.5,"s":"{1","k":{"k":null}}'), (2, "{}"), (3, None), (4, "[1]"), (5, "{")], "k int, j string")
    assert {tuple(r) for r in graph.flat_properties(d, "k", "j").collect()} == {(1, "x", "number", "1.5"), (1, "a.b.c.d.e.f", "number", "7"), (1, "s", "string", "{1")}
    assert graph.flat_properties(d.where("k > 1"), "k", "j").count() == 0
    chain = hashing.hash_chain(spark.range(150).selectExpr("0 AS k", "id", "CAST(id AS string) AS v"), "k", "id", "v")
    assert chain.select("chain").distinct().count() == 150


def test_spend_window_is_exact_to_the_microsecond(spark, tmp_path):
    at = ["2024-01-19 12:00:00", "2024-01-19 12:00:00.000001", "2024-01-19 12:00:00.5", "2024-01-20 12:00:00", "2024-01-20 12:00:00.000001"]
    kinds = [("view", 1.0), ("click", 0.125), ("click", 0.375), ("error", 9.0), (None, 2.5), ("click", None), ("view", None)]
    events = [(100 * k + n, k, s, kind, value) for n, s in enumerate(at) for k, (kind, value) in enumerate(kinds)] + [(900, None, at[2], "click", 0.125), (901, 9, None, "click", 1.0)]
    con = duckdb.connect()
    con.execute("CREATE TABLE events (event_id BIGINT, user_id BIGINT, ts TIMESTAMP, event_type VARCHAR, value DOUBLE)")
    con.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?)", events)
    con.execute(f"COPY events TO '{tmp_path}/events.parquet'")
    want = con.execute(ORACLE_SQL["spend_window"]).fetchall()
    assert (0, 30, 3) in want and (1, 36, 3) in want and (5, None, 3) in want
    assert rows(QUERIES["spend_window"](spark, str(tmp_path)).select("key", "used", "requests").collect()) == rows(want)


def test_ngram_scores_need_no_row_for_each_hit_and_query(spark, small_corpus, tmp_path):
    sf_dir, docs, items = small_corpus
    d = spark.createDataFrame([(k * 100 + i, f"{b or ''} {s or ''}".lower(), (b or "").lower().split("\n")[0], s) for k in range(7) for i, b, s in docs], "doc_id long, text string, name string, source string")
    terms = retrieval.query_terms(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text", {3: 0.65, 2: 0.35}, cap=480)
    args = (terms, 56, "item_id", "doc_id", "text", 9, [("name", 8.0), ("source", 4.0)])
    got = retrieval.containment_top_k(d, *args)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    want = rows(retrieval.containment_top_k(d, *args, cells=0).select("item_id", "doc_id", "score", "rank").collect())
    assert rows(got.select("item_id", "doc_id", "score", "rank").collect()) == want and len(want) > 30
    # repeated ids add up
    twice = d.unionByName(d.where("doc_id = 1"))
    assert rows(retrieval.containment_top_k(twice, *args).collect()) == rows(retrieval.containment_top_k(twice, *args, cells=0).collect())
    assert retrieval.containment_top_k(d.limit(0), *args).count() == 0
