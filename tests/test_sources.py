"""Sources, sinks, packages, NDJSON batches and row helpers on small tables."""

import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from loomlake.functions import records
from loomlake.operators import claims, normalize, projection, review, shortlists
from loomlake.sources import bundles, documents, paged, readers, sinks
from loomlake.streaming import ndjson


def zipped(members, **kw):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in members.items():
            z.writestr(name, body)
    return out.getvalue()


def test_xml_records_at_any_depth(spark):
    d = spark.createDataFrame([(1, "<r><i><a>x</a></i><g><i a='q'><a>y</a><b>z</b></i></g><i/></r>"), (2, "<r/>"), (3, "<r>"), (4, None), (5, '<!DOCTYPE x [<!ENTITY a "b">]><i/>')], "k int, body string")
    assert [tuple(r) for r in documents.xml_records(d, "body", "i", ["a", "b"]).orderBy("k", "n").collect()] == [(1, 1, "x", None, None), (1, 2, "y", "z", None), (1, 3, None, None, None), (3, 1, None, None, "INVALID_XML"), (5, 1, None, None, "INVALID_XML")]


def test_packages(spark, tmp_path):
    p = '<s xmlns:h="u">{}</s>'
    para = lambda t: f"<h:p><h:run><h:t>{t}</h:t></h:run></h:p>"
    table = f'<h:tbl><h:tr><h:tc><h:cellAddr rowAddr="4" colAddr="2"/>{para("cell")}</h:tc><h:tc>{para("é")}</h:tc></h:tr></h:tbl>'
    spine = '<package><manifest><item id="b" href="Contents/section1.xml"/><item id="a" href="Contents/section0.xml"/></manifest><spine><itemref idref="b"/><itemref idref="a"/></spine></package>'
    (tmp_path / "d.hwpx").write_bytes(zipped({"Contents/section0.xml": p.format(para("one") + table), "Contents/section1.xml": p.format(para("first")), "Contents/content.hpf": spine}))
    (tmp_path / "bad.hwpx").write_bytes(b"no package")
    broken = bytearray(zipped({"Contents/section0.xml": p.format(para("word " * 500))}))
    broken[60:90] = b"\xff" * 30
    (tmp_path / "torn.hwpx").write_bytes(bytes(broken))
    got = [(r["path"].rsplit("/", 1)[1], r["section"], r["n"], r["kind"], r["table_no"], r["row_no"], r["col_no"], r["text"], r["error_code"]) for r in documents.hwpx_blocks(readers.raw_files(spark, str(tmp_path))).collect()]
    assert sorted(got, key=str) == sorted([("d.hwpx", 0, 0, "paragraph", None, None, None, "first", None), ("d.hwpx", 1, 1, "paragraph", None, None, None, "one", None), ("d.hwpx", 1, 2, "cell", 0, 4, 2, "cell", None), ("d.hwpx", 1, 3, "cell", 0, 0, 1, "é", None), ("bad.hwpx", *[None] * 7, "PACKAGE"), ("torn.hwpx", *[None] * 7, "PACKAGE")], key=str)


def test_document_blocks_tile_their_text(spark, tmp_path, monkeypatch):
    word = '<w:document xmlns:w="u"><w:p><w:r><w:t>He</w:t></w:r><w:r><w:t>ad</w:t></w:r></w:p><w:p><w:r><w:t>énd</w:t></w:r></w:p></w:document>'
    sheet = '<worksheet><row><c t="s"><v>0</v></c><c><v>7</v></c></row><row><c t="inlineStr"><is><t>in</t></is></c></row></worksheet>'
    docx, xlsx = zipped({"word/document.xml": word}), zipped({"xl/sharedStrings.xml": "<sst><si><t>shared</t></si></sst>", "xl/worksheets/sheet1.xml": sheet})
    for name, body in {"a.docx": docx, "b.xlsx": xlsx, "c.zip": zipped({"in/a.docx": docx, "x.pdf": b"%PDF-1.7", "y.txt": "one\r\n\r\ntwo"}), "e.txt": "﻿one\n\n\ntwo\nthree".encode(), "f.bin": b"\x00\x01\x02", "g.txt": b""}.items():
        (tmp_path / name).write_bytes(body if isinstance(body, bytes) else body.encode())
    files = readers.raw_files(spark, str(tmp_path))
    d = documents.document_blocks(files).withColumn("file", F.regexp_extract("path", "[^/]*$", 0))
    got = {(r["file"], r["member"]): [] for r in d.collect()}
    for r in sorted(d.collect(), key=lambda r: r["n"] or 0):
        got[r["file"], r["member"]].append((r["start"], r["stop"], r["text"], r["error_code"]))
    assert got == {
        ("a.docx", ""): [(0, 4, "Head", None), (6, 9, "énd", None)], ("b.xlsx", ""): [(0, 8, "shared\t7", None), (10, 12, "in", None)], ("c.zip", "in/a.docx"): [(0, 4, "Head", None), (6, 9, "énd", None)], ("c.zip", "x.pdf"): [(None, None, None, "UNSUPPORTED")],
        ("c.zip", "y.txt"): [(0, 3, "one", None), (5, 8, "two", None)], ("e.txt", ""): [(0, 3, "one", None), (5, 14, "two\nthree", None)], ("f.bin", ""): [(None, None, None, "UNSUPPORTED")],
    }
    key = F.concat_ws("!", "file", "member")
    good = d.where("error_code IS NULL").withColumn("k", key)
    texts = good.groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: x["text"]), "\n\n").alias("text"))
    assert documents.tiling_issues(good, texts, "k").count() == 0
    assert documents.tiling_issues(good, texts.withColumn("text", F.concat("text", F.lit("!"))), "k").count() == texts.count()
    assert {r["issue"] for r in documents.tiling_issues(good.where("n <> 0 OR k <> 'a.docx!'"), texts.where("k = 'a.docx!'"), "k").collect()} == {"BLOCKS_DO_NOT_TILE"}
    lines = spark.createDataFrame([("k", 1, 0, 5), ("k", 2, 6, 9), ("k", 3, 20, 30), ("j", 1, 0, 5)], "k string, line_no int, start int, stop int")
    blocks = spark.createDataFrame([("k", 7, 4, 8), ("k", 8, 9, 20)], "k string, n int, start int, stop int")
    assert {tuple(r) for r in documents.block_lines(lines, blocks, ["k"], 8).collect()} == {("k", 1, 7), ("k", 2, 7), ("k", 3, None), ("j", 1, None)}


def test_sniffing_and_inspecting(spark, tmp_path):
    d = spark.createDataFrame([('{"a":{"k":1,"b":[{"k":"x"},{"k":null},{"k":true}]}}',), ("﻿<r><k>2</k><g><k> y </k></g></r>",), ("{",), (None,), ("plain",)], "b string")
    got = d.select(documents.body_format(F.col("b")), documents.find_values(F.col("b"), F.lit("k")), documents.first_int(F.col("b"), "k")).collect()
    assert [tuple(r) for r in got] == [("json", ["1", "x", "true"], 1), ("xml", ["2", "y"], 2), ("json", [], None), (None, [], None), ("other", [], None)]
    for name, body in {"a.csv": "﻿이름,값\n가,1\n".encode(), "b.csv": "이름,값\n가,\"x\ny\"\n나,2\n".encode("cp949"), "c.csv": b"a,b\n", "d.csv": "이름,값\n가\n".encode(), "f.csv": b"\xff\xff\xff", "g.csv": "이름,값\n".encode()}.items():
        (tmp_path / name).write_bytes(body)
    got = {(r["path"][-5:], r["rows"], r["encoding"], r["error"], r["valid"]) for r in documents.inspect_csv(readers.raw_files(spark, str(tmp_path)), ["이름", "값"]).collect()}
    assert got == {("a.csv", 1, "UTF-8", None, True), ("b.csv", 2, "CP949", None, True), ("c.csv", None, "UTF-8", "HEADER", False), ("d.csv", 0, "UTF-8", "WIDTH", False), ("f.csv", None, None, "ENCODING", False), ("g.csv", 0, "UTF-8", "NO_ROWS", False)}
    issue = spark.createDataFrame([(b"%PDF-1", "pdf"), (b"PK\x03\x04", "hwpx"), (b"x", "pdf"), (b"", "pdf")], "c binary, e string").select(readers.body_issue(F.col("c"), F.col("e"))).collect()
    assert [r[0] for r in issue] == [None, None, "MAGIC", "EMPTY"]


def test_tab_rows_and_typed_fields(spark, tmp_path):
    (tmp_path / "t.txt").write_bytes("Code\tValue\tFlag\r\n1-1\t2.50\tY\r\n1-2\tn/a\tn/a\nbad\n".encode())
    d = documents.tab_rows(readers.raw_files(spark, str(tmp_path)), ["Code", "Value", "Flag"])
    got = d.select("line", "Code", documents.decimal_field(F.col("Value"), 2).cast("string").alias("v"), documents.flag_field(F.col("Flag")).alias("f"), "error_code").orderBy("line").collect()
    assert [tuple(r) for r in got] == [(2, "1-1", "2.50", True, None), (3, "1-2", None, None, None), (4, None, None, None, "WIDTH")]


def batch(run, start_byte, start_line, text, sha=None):
    return (run, start_byte, start_line, text, sha or hashlib.sha256((text or "").encode()).hexdigest())


BATCH = "run_id string, start_byte long, start_line long, text string, sha256 string"


def test_ndjson_batches_resume_replay_and_conflict(spark, tmp_path):
    path = str(tmp_path / "run")
    one, two, three = '{"a":1}\n{"a":2}\r\n', '{"é":3}\n', '{"a":4}\n'
    at = [0, len(one), len(one) + len(two.encode())]
    send = lambda *rows: {(r["start_byte"], r["outcome"], r["location"]) for r in ndjson.append(spark, path, spark.createDataFrame(list(rows), BATCH)).collect()}
    assert send(batch("r", 0, 1, one)) == {(0, "NEW", None)}
    assert send(batch("r", 0, 1, one)) == {(0, "REPLAYED", None)}
    assert send(batch("r", 0, 1, '{"a":9}\n{"a":2}\r\n')) == {(0, "REPLAY_CONFLICT", None)}
    assert send(batch("r", at[2], 4, three)) == {(at[2], "CHECKPOINT", None)}  # a gap
    assert send(batch("r", at[1], 3, two), batch("r", at[2], 4, three)) == {(at[1], "NEW", None), (at[2], "NEW", None)}
    for text, issue in (('{"a":1}', "FINAL_NEWLINE_REQUIRED"), ("\n", "BLANK_LINE"), ("[1]\n", "INVALID_JSON"), ('{"a":1,"a":1}\n', "REPEATED_KEY"), ("﻿{}\n", "BYTE_ORDER_MARK")):
        assert send(batch("x", 0, 1, text)) == {(0, issue, "line:1@byte:0")}
    assert send(batch("x", 0, 1, '{"a":1}\n', "0")) == {(0, "HASH_OR_SIZE", "line:1@byte:0")}
    assert send(batch("x", 0, 1, '{"a":1}\n{\n')) == {(0, "INVALID_JSON", "line:2@byte:8")}
    chunks = spark.read.parquet(f"{path}/chunks")
    whole = sum(len(x.encode()) for x in (one, two, three))
    files = spark.createDataFrame([("r", whole), ("none", 5)], "run_id string, byte_length long")
    got = {r["run_id"]: (r["state"], r["lines"], r["chain"] is not None) for r in ndjson.sealed(chunks, files).collect()}
    assert got == {"r": ("READY", 4, True), "none": ("CHECKPOINT_INCOMPLETE", 0, False)}
    assert ndjson.sealed(chunks, files.withColumn("byte_length", F.lit(whole + 1))).where("run_id = 'r'").first()["state"] == "CHECKPOINT_INCOMPLETE"
    assert spark.read.parquet(f"{path}/lines").count() == 4


def test_latest_state_keeps_the_newest(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    run = lambda: ndjson.latest_state(spark, spark.readStream.schema("k int, at int, v string").json(str(src)), str(tmp_path / "state"), ["k"], ["at"], str(tmp_path / "mark"), 4)
    (src / "1.json").write_text('{"k":1,"at":5,"v":"a"}\n{"k":2,"at":1,"v":"b"}\n')
    run()
    (src / "2.json").write_text('{"k":1,"at":3,"v":"older"}\n{"k":2,"at":2,"v":"newer"}\n{"k":3,"at":1,"v":"c"}\n')
    run()
    run()
    assert {(r["k"], r["v"]) for r in spark.read.parquet(str(tmp_path / "state")).collect()} == {(1, "a"), (2, "newer"), (3, "c")}


def test_windowed_counts(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"k":"a","at":"2024-01-01T01:00:00"}\n{"k":"a","at":"2024-01-01T02:00:00"}\n{"k":"a","at":"2024-01-02T00:00:00"}\n')
    stream = spark.readStream.schema("k string, at timestamp").json(str(tmp_path))
    q = ndjson.windowed_counts(stream, "at", "k").writeStream.format("memory").queryName("counted").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["n"] for r in spark.table("counted").collect()) == [1, 2]


def test_paged_plans(spark):
    first = spark.createDataFrame([("p", 101), ("z", 0), ("one", 50)], "partition_id string, declared_total long")
    assert {tuple(r) for r in paged.planned_requests(first, 50).collect()} == {("p", 1, 0), ("p", 2, 0), ("p", 3, 0), ("z", 1, 0), ("z", 1, 1), ("one", 1, 0)}
    with pytest.raises(Exception, match="too many pages"):
        paged.planned_requests(first, 1, 100).collect()
    r = paged.Registry()
    r.add(paged.Source("b", "PAGED", depends_on=("a",)))
    r.add(paged.Source("a", "FILE", header=("x",)))
    assert r.order() == ["a", "b"]
    with pytest.raises(ValueError):
        r.add(paged.Source("a", "FILE"))
    with pytest.raises(ValueError):
        r.add(paged.Source("c", "LIVE"))


def test_run_inputs_need_their_manifest(spark):
    from loomlake.functions.hashing import set_hash

    snapshots = spark.createDataFrame([("r1", "s1"), ("r2", "s2")], "run_id string, snapshot_id string")
    seen = spark.createDataFrame([("s1", 1, "a"), ("s1", 2, "b"), ("s2", 3, "c")], "snapshot_id string, observation_id int, content_sha256 string")
    said = spark.createDataFrame([("r1", "1:a"), ("r1", "2:b"), ("r2", "3:changed"), ("r3", "4:d")], "run_id string, m string")
    manifest = set_hash(said, ["run_id"], "m").select("run_id", "set_hash")
    assert {r["observation_id"] for r in paged.run_inputs(snapshots, seen, manifest).collect()} == {1, 2}
    assert {r["run_id"] for r in paged.unproven(snapshots, seen, manifest).collect()} == {"r2", "r3"}


def test_archive_moves_exactly_the_manifest(spark, tmp_path):
    table, old = str(tmp_path / "t"), str(tmp_path / "a")
    spark.createDataFrame([(k, "c", k // 3) for k in range(9)], "k int, c string, part int").write.partitionBy("part").parquet(table)
    gone = spark.createDataFrame([(0,), (1,), (2,), (4,)], "k int")
    assert sinks.move_to_archive(spark, table, old, gone, ["k"], "part") == 4
    assert {r["k"] for r in spark.read.parquet(table).collect()} == {3, 5, 6, 7, 8} and spark.read.parquet(old).count() == 4
    with pytest.raises(sinks.Conflict):
        sinks.archive(spark.read.parquet(table), gone, ["k"])
    with pytest.raises(sinks.Conflict):
        sinks.store_additions(sinks.content_rows(spark.createDataFrame([(b"x",)], "c binary"), "c"), sinks.content_rows(spark.createDataFrame([(b"yy",), (b"x",)], "c binary"), "c"), free_bytes=1)


def test_normalizers_edges(spark):
    rows = ['{"instCd":"A","instNm":"N\\r\\nx","fndnYmd":"20260230"}', '{"instCd":"B","instNm":" é ","fndnYmd":""}', '{"instCd":true,"instNm":"x"}', '{"instCd":7,"instNm":"x","fndnYmd":"２０２４０１０２"}', "[]", "{", None, '{"instNm":"x"}', '{"instCd":"a","instCd":"b"}']
    d = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(rows)], "i int, b string, normalized string").drop("normalized")
    got = {r["i"]: (r["error_code"], r["source_record_id"], r["normalized"] and r["normalized"]["name"], r["normalized"] and str(r["normalized"]["established_date"])) for r in normalize.normalize(d, "b", "organization").collect()}
    assert got == {0: ("INVALID_DATE", None, None, None), 1: (None, "B", "é", "None"), 2: ("INVALID_STRING", None, None, None), 3: (None, "7", "x", "2024-01-02"), 4: ("ROW_NOT_OBJECT", None, None, None), 5: ("ROW_NOT_OBJECT", None, None, None), 6: ("ROW_NOT_OBJECT", None, None, None), 7: ("MISSING_REQUIRED_FIELD", None, None, None), 8: ("ROW_NOT_OBJECT", None, None, None)}
    path = {"대분류코드": "1", "중분류코드": "2", "소분류코드": "03", "직무코드": 4, "직무역량코드": "5", "직무명": "a", "직무역량명": "b", "직무역량수준(능력단위수준 이면서 세분류의 자식)": "3", "수준(직급수준)": "2", "직급명": "c"}
    import json

    d = spark.createDataFrame([(1, json.dumps(path, ensure_ascii=False)), (2, json.dumps(path | {"직무코드": "100"})), (3, json.dumps(path | {"소분류코드": "x"}))], "i int, b string")
    got = {r["i"]: (r["error_code"], r["normalized"] and r["normalized"]["competency_code"], r["lineage"] and r["lineage"]["occupation_code"]) for r in normalize.normalize(d, "b", "career_path").collect()}
    assert got == {1: (None, "0102030405", ["/대분류코드", "/중분류코드", "/소분류코드", "/직무코드"]), 2: ("INVALID_CODE", None, None), 3: ("INVALID_NONNEGATIVE_INTEGER", None, None)}
    qual = '{"ncsClCd":"0123456789_12v1","jmCd":"Q","jmNm":"n","organStdVerCd":"1","abltUnitTypCd":"t","minEduTrngTm":"x"}'
    d = spark.createDataFrame([(1, qual.replace('"x"', '""'), "ncs-0123456789_12v1"), (2, qual, "ncs-0123456789_12v1"), (3, qual, "ncs-0")], "i int, b string, p string")
    assert {r["i"]: (r["error_code"], r["source_record_id"]) for r in normalize.normalize(d, "b", "qualification", "p").collect()} == {1: (None, "0123456789_12v1:Q:1"), 2: ("INVALID_NONNEGATIVE_INTEGER", None), 3: ("PARTITION_IDENTITY_MISMATCH", None)}


def test_shortlist_hints_and_admission(spark):
    texts = spark.createDataFrame([(1, "physics and physical therapy"), (2, "physical"), (3, None)], "query int, text string")
    rules = [("physical therapy|therapist", "therapists", ["T"]), ("physical", "physics", ["P"])]
    got = {(r["query"], r["matched"], r["expansion"]) for r in shortlists.alias_hints(texts, rules).collect()}
    assert got == {(1, "physical therapy", "therapists"), (2, "physical", "physics")}
    catalog = spark.createDataFrame([("T", "Therapist", "helps bodies"), ("P", "Physicist", "physics"), ("O", "All Other", "physics")], "code string, label string, body string")
    q = spark.createDataFrame([(1, "title", "physics and physical therapy"), (2, "title", "physical"), (2, "body", "physical"), (3, "title", None)], "query int, field string, text string")
    got = {(r["query"], r["code"], r["rank"]) for r in shortlists.field_bm25(catalog, q, {"title": 1.0, "body": 0.3}, 5, rules=rules).collect()}
    assert got == {(1, "T", 1), (1, "P", 2), (2, "P", 1)}
    assert shortlists.field_bm25(catalog.limit(0), q, {"title": 1.0}, 5).count() == 0
    s = spark.createDataFrame([("policies",), ("buses",), ("status",), ("glass",), ("cars",), ("gas",)], "w string").select(shortlists.stem(F.col("w"))).collect()
    assert [r[0] for r in s] == ["policy", "buse", "status", "glass", "cars", "gas"]


def test_expectations_of_reviews(spark):
    entities = spark.createDataFrame([(1,), (2,)], "entity int")
    members = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "entity int, cluster string")
    ok = spark.createDataFrame([("a", "ACCEPTED"), ("b", "ACCEPTED")], "cluster string, status string")
    ids, several = review.group_ids(entities, members, ok)
    assert [r["entity"] for r in several.collect()] == [1] and ids.count() == 2
    with pytest.raises(ValueError):
        review.entity_page(spark.createDataFrame([("r", 1, "k")], "release_id string, entity int, kind string"), "r", 1, review.page_cursor("r/k", 1))
    trees = spark.createDataFrame([(1, []), (2, [("A", None, [5])]), (3, [("A", "t", None)])], "k int, n array<struct<op:string,text:string,children:array<int>>>")
    assert {tuple(r) for r in review.tree_parts(trees, "k", "n").collect()} == {(2, "0", "INVALID", None, 0), (3, "0", "A", "t", 0)}


def test_row_helpers(spark):
    d = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    assert {tuple(r) for r in records.ordinals(d, ["k"]).collect()} == {(1, 1), (2, 2), (3, 3)}
    assert records.ordinals(d.limit(0), ["k"]).count() == 0
    assert {tuple(r) for r in records.zip_rows(d, ["k"], spark.createDataFrame([("b",), ("a",)], "v string"), ["v"]).collect()} == {(1, 1, "a"), (2, 2, "b")}
    urls = ["https://u:p@Host.com:8080/a?token=1&b=2#f", "ftp://x", "http://[", None]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(records.redacted_url("u")).collect()]
    assert got == ["https://host.com:8080/a?b=2&token=REDACTED", None, None, None]
    deep = {"properties": {"x": {"$ref": "#/$defs/a"}}, "$defs": {"a": {"$ref": "#/$defs/a"}}}
    assert records.schema_issues({"x": 1}, deep) == ["/x:SCHEMA_DEPTH_LIMIT"] and records.schema_issues(True, {"type": "integer"}) == [":TYPE"]
    assert projection.backbone(spark.createDataFrame([("e", "K", None, 1, "s")], "entity string, kind string, label string, priority int, source string"), spark.createDataFrame([], "subject string, predicate string, object string"))[0].first()["label"] == "e"


def test_review_packets_round_trip(spark, tmp_path):
    path = str(tmp_path / "packets")
    items = spark.createDataFrame([(k, f"text {k}", None) for k in range(5)], "item int, text string, note string")
    claims.export_packets(items, path, "item", 2)
    asked = spark.read.json(path)
    assert asked.groupBy("packet").count().count() == 3
    h = {r["key"]: r["content_hash"] for r in asked.collect()}
    rows = [("0", h["0"], "ACCEPT", "ann"), ("1", "other", "ACCEPT", "ann"), ("9", h["0"], "ACCEPT", "ann"), ("2", h["2"], "MAYBE", "ann"), ("3", h["3"], "ACCEPT", "ann"), ("3", h["3"], "REJECT", "ann"), ("3", h["3"], "REJECT", "bob"), ("0", h["0"], "ACCEPT", "ann")]
    good, bad = claims.import_answers(spark, path, spark.createDataFrame(rows, "key string, content_hash string, decision string, reviewer string"))
    assert {(r["key"], r["reviewer"]) for r in good.collect()} == {("0", "ann"), ("3", "bob")}
    assert sorted((r["key"], r["issue"]) for r in bad.collect()) == [("1", "CONTENT_CHANGED"), ("2", "INVALID_DECISION"), ("3", "ANSWERED_TWICE"), ("3", "ANSWERED_TWICE"), ("9", "NOT_ASKED")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        claims.export_packets(items, path, "item")


def test_bundles(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "a.txt").write_text("a")
    (tmp_path / "in" / "b.txt").write_text("b")
    files = readers.raw_files(spark, f"{tmp_path}/*.txt").unionByName(readers.raw_files(spark, f"{tmp_path}/in"))
    m = bundles.manifest(files, str(tmp_path))
    assert {r["name"] for r in m.collect()} == {"a.txt", "in/b.txt"}
    assert bundles.bundle_hash(m) == bundles.bundle_hash(m.repartition(3)) and bundles.bundle_hash(m.limit(0)) is None
    assert bundles.bundle_issues(m, m).count() == 0
    assert {(r["name"], r["issue"]) for r in bundles.bundle_issues(m, m.unionByName(m.where("name = 'a.txt'"))).collect()} == {("a.txt", "REPEATED_NAME")}
    codes = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", " ")], "code string, title string")
    tree = spark.createDataFrame([("1", None), ("2", "9")], "code string, parent string")
    _, issues = bundles.catalogue(codes, tree, spark.createDataFrame([("e", "x")], "element_id string, name string"), spark.createDataFrame([("7", "f", "s", 1.0, False)], "code string, element_id string, scale string, value double, suppress boolean"))
    assert {tuple(r) for r in issues.collect()} == {("REPEATED_CODE", "1"), ("TITLE_MISSING", "2"), ("PARENT_MISSING", "2"), ("RATED_CODE_MISSING", "7"), ("ELEMENT_MISSING", "f")}


def test_xml_sections_edges(spark):
    d = spark.createDataFrame([(1, "<html><body>  </body></html>"), (2, "<"), (3, None), (4, "<html><body><p>a</p>\n<p>b</p></body></html>")], "k int, x string")
    assert {tuple(r) for r in documents.xml_sections(d, "k", "x").collect()} == {(2, 0, None, None, None, "INVALID_XML"), (4, 0, "body", None, "a b", None)}
