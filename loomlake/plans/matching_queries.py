"""Shortlists, cues, admission, scores of an evaluation over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, shortlists
from .registry import query, t

_CATALOG = "SELECT item_id AS code, split_part(text, '. ', 1) AS name, split_part(text, '. ', 2) AS grp, text AS body FROM benchmark"
_FIELDS = f"c AS (SELECT code, lower(name) AS name, lower(grp) AS grp, lower(name || ' ' || grp || ' ' || body) AS every FROM ({_CATALOG}))"


def _catalog(spark, sf_dir):
    return t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("code"), F.split_part("text", F.lit(". "), F.lit(1)).alias("name"), F.split_part("text", F.lit(". "), F.lit(2)).alias("group_name"), F.col("text").alias("body"))


def _duties(spark, sf_dir):
    return t(spark, sf_dir, "part").select(F.col("p_brand").alias("query"), F.col("p_type").alias("duty"), F.concat_ws(" ", "p_name", F.lit("ONTHTHTION"), "p_type").alias("text"))


@query(f"""WITH {_FIELDS}, w AS (SELECT DISTINCT p_brand AS q, unnest(string_split(lower(p_name || ' ONTHTHTION ' || p_type), ' ')) AS word FROM part), k AS (SELECT q, word FROM w QUALIFY row_number() OVER (PARTITION BY q ORDER BY word) <= 80),
s AS (SELECT q, code, sum(CASE WHEN contains(name, word) THEN 6 WHEN contains(grp, word) THEN 3 ELSE 1 END) + max(CASE WHEN contains('R6000' || q, 'R6000' || (code::VARCHAR)[:2]) THEN 1 ELSE 0 END) AS score FROM k, c WHERE contains(every, word) GROUP BY ALL)
SELECT q AS query, code, score::DOUBLE AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, code) AS rank FROM s) WHERE rank <= 7""")
def token_shortlist(spark, sf_dir):
    d = _duties(spark, sf_dir).withColumn("hint", F.concat(F.lit("R6000"), "query"))
    return shortlists.token_shortlist(d, _catalog(spark, sf_dir), 7, ("hint", "R6000"))


_TERMS = """g AS (SELECT q, duty, word AS term, 1.0 AS weight FROM w UNION ALL SELECT q, duty, unnest([word[i:i + 2] for i in range(1, length(word) - 1)]), {a} FROM w WHERE length(word) > 3 AND regexp_matches(word, '^[a-z]+$') UNION ALL
SELECT q, duty, unnest([word[i:i + 1] for i in range(1, length(word))]), {b} FROM w WHERE length(word) > 2 AND regexp_matches(word, '^[a-z]+$'))"""


@query(f"""WITH {_FIELDS}, w AS (SELECT DISTINCT p_brand AS q, p_type AS duty, unnest(string_split(lower(p_name || ' ONTHTHTION ' || p_type), ' ')) AS word FROM part), {_TERMS.format(a=0.65, b=0.35)},
m AS (SELECT q, duty, term, max(weight) AS weight FROM g GROUP BY ALL), t AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY q ORDER BY duty, weight DESC, length(term) DESC, term) <= 480),
h AS (SELECT term, code, CASE WHEN contains(name, term) THEN 8.0 WHEN contains(grp, term) THEN 4.0 ELSE 1.0 END AS loc FROM (SELECT DISTINCT term FROM t), c WHERE contains(every, term)), df AS (SELECT term, count(*) AS df FROM h GROUP BY 1),
s AS (SELECT q, duty, code, CAST(round(CAST(sum(weight::DOUBLE * loc::DOUBLE * ln(1 + (SELECT count(*) FROM benchmark) / df::DOUBLE)) AS DECIMAL(28,9)), 6) AS DOUBLE) AS score FROM t JOIN h USING (term) JOIN df USING (term) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY q, duty ORDER BY score DESC, code) AS r FROM s), b AS (SELECT q, code, max(score) AS score, min(r) AS best_rank FROM r GROUP BY ALL),
k AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY q ORDER BY best_rank, score DESC, code) <= 200), l AS (SELECT k.* FROM k JOIN ({_CATALOG}) n USING (code) WHERE NOT regexp_matches(n.name, '(Re|In)'))
SELECT q AS query, code, round(score, 3) AS score, best_rank, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY best_rank, score DESC, code) AS rank FROM l) WHERE rank <= 9""")
def duty_shortlist(spark, sf_dir):
    return shortlists.duty_shortlist(_duties(spark, sf_dir), _catalog(spark, sf_dir), 9, obsolete="(Re|In)", gram_words="^[a-z]+$")


@query(f"""WITH {_FIELDS}, x AS (SELECT p_partkey AS q, lower(p_name || ' ' || p_type) AS txt FROM part), w AS (SELECT DISTINCT q, 0 AS duty, unnest(string_split(txt, ' ')) AS word FROM x), {_TERMS.format(a=0.4, b=0.15)},
a AS (SELECT q, 'tion' AS term FROM x WHERE regexp_matches(txt, 'gear|bolt') UNION ALL SELECT q, 'the' FROM x WHERE regexp_matches(txt, '^(hot|cold)')), f AS (SELECT q, term, weight FROM g WHERE term NOT IN ('in') UNION ALL SELECT q, term, 2.5 FROM a),
m AS (SELECT q, term, max(weight) AS weight FROM f GROUP BY ALL), t AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY q ORDER BY weight DESC, length(term) DESC, term) <= 12),
h AS (SELECT term, code, CASE WHEN contains(name, term) THEN 8.0 ELSE 1.0 END AS loc FROM (SELECT DISTINCT term FROM t), c WHERE contains(every, term)), df AS (SELECT term, count(*) AS df FROM h GROUP BY 1),
s AS (SELECT q, code, CAST(round(CAST(sum(weight::DOUBLE * loc::DOUBLE * ln(1 + (SELECT count(*) FROM benchmark) / df::DOUBLE)) AS DECIMAL(28,9)), 6) AS DOUBLE) AS score FROM t JOIN h USING (term) JOIN df USING (term) GROUP BY ALL)
SELECT q AS query, code, round(score, 3) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, code) AS rank FROM s) WHERE rank <= 3""")
def metadata_shortlist(spark, sf_dir):
    q = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("query"), F.concat_ws(" ", "p_name", "p_type").alias("text"))
    return shortlists.metadata_shortlist(q, _catalog(spark, sf_dir), 3, [("gear|bolt", "tion"), ("^(hot|cold)", "the")], cap=12, gram_words="^[a-z]+$", term_stop=("in",))


_STEM = "CASE WHEN length({0}) > 5 AND {0}[-3:] = 'ies' THEN {0}[:-4] || 'y' WHEN length({0}) > 4 AND {0}[-1:] = 's' AND NOT regexp_matches({0}, '(ss|us|is)$') THEN {0}[:-2] ELSE {0} END"
_WORDS = "list_filter(regexp_extract_all(lower({}), '[a-z][a-z0-9]*'), lambda w: w NOT IN ('the', 'and'))"


@query(f"""WITH c AS (SELECT code, {_WORDS.format("name")} AS a, {_WORDS.format("body")} AS b FROM ({_CATALOG}) WHERE NOT contains(lower(name), 'tion')), x AS (SELECT code, unnest(list_concat(list_concat(list_concat(a, a), list_concat(a, a)), b)) AS w FROM c),
tf AS (SELECT code, {_STEM.format("w")} AS term, count(*) AS tf FROM x GROUP BY ALL), len AS (SELECT code, sum(tf) AS len FROM tf GROUP BY 1), st AS (SELECT count(*) AS n, (SELECT avg(coalesce(len, 0)) FROM c LEFT JOIN len USING (code)) AS avg FROM c),
q0 AS (SELECT doc_id % 50 AS q, lower(split_part(text, chr(10), 1)) AS txt, CASE WHEN doc_id % 3 = 0 THEN 1.0 WHEN doc_id % 3 = 1 THEN 0.9 ELSE 0.3 END AS weight FROM documents WHERE text IS NOT NULL), q AS (SELECT q, txt, max(weight) AS weight FROM q0 GROUP BY ALL),
h0 AS (SELECT q, weight, txt, regexp_extract(txt, 'there|the') AS m1, strpos(txt, regexp_extract(txt, 'there|the')) AS p1 FROM q), o AS (SELECT q, w, weight FROM (SELECT q, unnest({_WORDS.format("txt")}) AS w, weight FROM q)),
s AS (SELECT q, {_STEM.format("w")} AS term, max(weight) AS weight FROM o GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
p AS (SELECT q, code, sum(weight::DOUBLE * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg))) AS score FROM s JOIN tf USING (term) JOIN df USING (term) JOIN len USING (code), st GROUP BY ALL),
r AS (SELECT q, code, CAST(round(CAST(score AS DECIMAL(28,10)), 6) AS DOUBLE) AS score FROM p)
SELECT q AS query, code::VARCHAR AS code, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, code::VARCHAR) AS rank FROM r) WHERE rank <= 4""")
def field_bm25(spark, sf_dir):
    field = F.when(F.col("doc_id") % 3 == 0, "title").when(F.col("doc_id") % 3 == 1, "duties").otherwise("description")
    q = t(spark, sf_dir, "documents").select((F.col("doc_id") % 50).alias("query"), field.alias("field"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("text"))
    c = _catalog(spark, sf_dir).select("code", F.col("name").alias("label"), "body")
    d = shortlists.field_bm25(c, q, {"title": 1.0, "duties": 0.9, "description": 0.3}, 4, ("the", "and"), excluded="tion")
    return d.select("query", "code", F.round("score", 4).alias("score"))


@query("""WITH a AS (SELECT DISTINCT p_name AS id FROM part), b AS (SELECT item_id AS id, text FROM benchmark),
x AS (SELECT a.id AS source, b.id AS target, 'hot' AS cue, 'hot' AS source_quote, regexp_extract(b.text, 'thi\\w*') AS target_quote FROM a, b WHERE regexp_matches(a.id, 'hot|cold') AND regexp_matches(a.id, 'hot') AND regexp_matches(b.text, 'thi\\w*')
UNION ALL SELECT a.id, b.id, 'hot', 'cold', regexp_extract(b.text, 'thi\\w*') FROM a, b WHERE regexp_matches(a.id, 'cold') AND NOT regexp_matches(a.id, 'hot') AND regexp_matches(b.text, 'thi\\w*')
UNION ALL SELECT a.id, b.id, 'ring', 'ring', regexp_extract(b.text, '(?i)\\bin\\b') FROM a, b WHERE regexp_matches(a.id, 'ring') AND regexp_matches(b.text, '(?i)\\bin\\b'))
SELECT source, target, min(cue) AS cue, arg_min(source_quote, cue) AS source_quote, arg_min(target_quote, cue) AS target_quote FROM x GROUP BY 1, 2""")
def cue_crosswalk(spark, sf_dir):
    a = t(spark, sf_dir, "part").select(F.col("p_name").alias("id"), F.col("p_name").alias("text")).distinct()
    b = t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return shortlists.cue_proposals(a, b, [("hot", "hot|cold", r"thi\w*"), ("ring", "ring", r"(?i)\bin\b")])


@query(r"""WITH d AS (SELECT doc_id, text, text IS NOT NULL AND NOT regexp_matches(text, '(?i)license') AS open FROM documents), r AS (SELECT doc_id, CASE WHEN NOT open THEN NULL WHEN regexp_matches(text, '(?i)the then') THEN 'THEN' WHEN regexp_matches(text, '(?i)der ') THEN 'DER' END AS rule, text FROM d)
SELECT doc_id, rule, CASE WHEN rule IS NULL THEN 'ADMIT' ELSE 'EXCLUDE' END AS outcome, CASE WHEN rule IS NOT NULL THEN length(regexp_extract(text, CASE rule WHEN 'THEN' THEN '(?i)the then' ELSE '(?i)der ' END)) END AS size FROM r""")
def admission_policy(spark, sf_dir):
    d = shortlists.admission(t(spark, sf_dir, "documents", "doc_id", "text"), "text", [("THEN", "the then"), ("DER", "der ")], [("LICENSE", "license")])
    return d.select("doc_id", "rule", "outcome", (F.col("stop") - F.col("start")).alias("size"))


@query("""WITH g AS (SELECT o_custkey AS k, o_orderkey AS code FROM orders WHERE o_orderkey % 3 <> 0), s AS (SELECT o_custkey AS k, o_orderkey AS code, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
SELECT c AS cutoff, count(*) AS labels, count(*) FILTER (WHERE rank <= c) AS found, round(count(*) FILTER (WHERE rank <= c) / count(*)::DOUBLE, 6) AS recall FROM g LEFT JOIN s USING (k, code), (SELECT unnest([1, 5, 20]) AS c) GROUP BY 1""")
def retrieval_recall(spark, sf_dir):
    from pyspark.sql import Window

    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("code"), "o_totalprice")
    s = o.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("o_totalprice"), "code"))).select("k", "code", "rank")
    return evaluate.retrieval_recall(o.where("code % 3 <> 0").select("k", "code"), s, ["k", "code"], [1, 5, 20])


@query("""WITH g AS (SELECT l_orderkey AS k, l_returnflag AS label FROM lineitem WHERE l_linenumber <= 3 GROUP BY ALL), p AS (SELECT l_orderkey AS k, l_returnflag AS label FROM lineitem WHERE l_linenumber >= 3 GROUP BY ALL)
SELECT coalesce(g.label, p.label) AS label, count(*) FILTER (WHERE g.k IS NOT NULL AND p.k IS NOT NULL) AS matched, count(*) FILTER (WHERE p.k IS NULL) AS missed, count(*) FILTER (WHERE g.k IS NULL) AS added FROM g FULL JOIN p ON g.k = p.k AND g.label = p.label GROUP BY 1""")
def label_matches(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("label"), "l_linenumber")
    return evaluate.label_matches(li.where("l_linenumber <= 3").drop("l_linenumber"), li.where("l_linenumber >= 3").drop("l_linenumber"), ["k"], "label")
