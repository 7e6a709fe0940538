"""The corpus pipeline against a brute-force version on a small table."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from loomlake.llm import packing, pii  # noqa: E402

from .test_operators import brute_components, brute_contamination  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def tables(spark, tmp_path):
    r = random.Random(8)
    en = "the of and with from that were upon which their".split() + ["".join(r.choices("abeinorst", k=6)) for _ in range(300)]
    de = "der die und mit von dass waren auf welche ihr".split() + ["".join(r.choices("äöüßchgknz", k=6)) for _ in range(300)]
    said = lambda v, n: " ".join(r.choices(v, k=n))
    docs = [(i, said([en, de][i % 2], r.randint(20, 90)), ["en", "de"][i % 2], "s", 0) for i in range(60)]
    docs += [(100 + i, docs[i][1] + " extra", "en", "s", 0) for i in range(0, 20, 2)] + [(200, docs[3][1], "de", "s", 0)]
    bench = [(0, said(en, 14)), (1, said(de, 6))]
    docs += [(300, f"{said(en, 20)} {bench[0][1]} {said(en, 5)}", "en", "s", 0), (301, f"{said(de, 9)} {bench[1][1]}", None, "s", 0)]
    docs += [(400, None, "en", "s", None), (401, "", "en", "s", 0), (402, "12 34 !", "en", "s", 7), (403, f"{said(en, 30)} an@be.co 10.0.0.1 call 555-123-4567 now", "en", "s", 0), (404, said(en, 9000), "en", "s", 0)]
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), docs, bench


def test_pipeline_matches_brute_force(spark, tables):
    sf_dir, docs, bench = tables
    kept = [(d, t) for d, t, *_ in docs if t and any(c.isalpha() for c in t)]
    root = {d: c for d, _, c in brute_components(kept)}
    kept = [(d, t) for d, t in kept if root[d] == d]
    hit = {d: h for d, _, h, _, _ in brute_contamination(kept, bench)}
    kept = [(d, t) for d, t in kept if not hit[d]]
    crf, tokens, want = pii.train(pii.training_table()), packing.CachedTokenizer(packing.VOCABULARY), {}
    for d, t in kept:
        base = pii.base_spans(t)
        at, out = 0, ""
        for a, k, b in sorted(base + pii.added_spans(crf, [t], [base])[0]):
            if a >= at:
                out += t[at:a] + f"<{k}>"
            at = max(at, b)
        want[d] = len(tokens.whole.encode(out + t[at:], add_special_tokens=False).ids) + 1
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    got, fill = {}, {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert got == want and max(fill.values()) <= 1024
    assert not {100, 200, 300, 301, 400, 401, 402} & set(got) and {0, 3, 403, 404} <= set(got)


def test_stages_keep_columns_and_stand_empty_tables(spark, tables):
    sf_dir, _, _ = tables
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf_dir).count() == 0


def test_stages_decide_by_row(spark, tmp_path):
    """Repeated and null ids: a row goes for its own text only, and one of each group stays."""
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    hit = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(5, words(1)), (5, words(1)), (5, words(2)), (None, words(2)), (None, words(3)), (None, words(3)), (7, words(4) + " " + hit), (7, words(5)), (None, hit), (9, words(6))]
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, hit)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages, docs = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{tmp_path}/documents.parquet")
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    said = lambda df: sorted(((x["doc_id"], x["text"]) for x in df.collect()), key=key)
    assert said(stages["near_duplicates"](spark, docs, str(tmp_path))) == sorted([rows[0], rows[2], rows[4], rows[6], rows[7], rows[8], rows[9]], key=key)
    loose = spark.createDataFrame(docs.collect(), COLUMNS).repartition(4)
    assert said(stages["near_duplicates"](spark, loose, str(tmp_path))) and len({x[0] for x in corpus_pipeline.numbered(docs).select(corpus_pipeline.ROW).collect()}) == len(rows)
    assert said(stages["decontamination"](spark, loose, str(tmp_path))) == said(stages["decontamination"](spark, docs, str(tmp_path)))
    assert said(stages["decontamination"](spark, docs, str(tmp_path))) == sorted([r for r in rows if hit not in r[1]], key=key)
