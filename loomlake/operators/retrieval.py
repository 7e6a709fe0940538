"""Lexical retrieval: containment joins, n-gram and IDF scores, BM25."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from ..functions.text import char_ngrams, words
from ..storage import cut


#: Letters of all terms up to which they are matched by one automaton in every task; beyond, by their rarest grams.
AUTOMATON_LETTERS = 4_000_000


#: Numbers of a table of terms by queries up to which scores are products of matrices.
SCORE_CELLS = 8_000_000


def automaton_of(terms) -> ahocorasick.Automaton:
    """Aho-Corasick automaton that numbers the terms in order."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, w in enumerate(terms):
        automaton.add_word(w, k)
    automaton.make_automaton()
    return automaton


def containment_join(texts: DataFrame, terms: DataFrame, text_id: str, text: str, term_id: str, term: str, gram: int = 3, letters: int = AUTOMATON_LETTERS, places: list[tuple[str, float]] | None = None, otherwise: float = 1.0) -> DataFrame:
    """(text_id, term_id): every non-empty term that occurs in a text, each pair once a row of texts.

    Terms of up to ``letters`` letters in all (counted before) are sent to the tasks as one Aho-Corasick automaton, which reads each text once. More
    terms are joined by :func:`containment_by_grams`. With ``places`` (columns of texts and their weights) there is a ``location``: the weight of the first of them that has
    the term too, else ``otherwise``.
    """
    t = terms.where(F.length(term) > 0).select(F.col(term_id).alias("_t"), F.col(term).alias("_term"))
    if (t.agg(F.sum(F.length("_term") + 1)).first()[0] or 0) > letters:
        found = containment_by_grams(texts, terms, text_id, text, term_id, term, gram)
        if not places:
            return found
        weight = F.lit(otherwise)
        for column, w in reversed(places):
            weight = F.when(F.contains(F.col(column), F.col("_term")), w).otherwise(weight)
        said = texts.select(F.col(text_id), *[c for c, _ in places]).join(found, text_id).join(t.select(F.col("_t").alias(term_id), "_term").distinct(), term_id)
        return said.select(text_id, term_id, weight.cast("double").alias("location"))
    by_term: dict[str, list] = {}
    for r in t.distinct().collect():
        by_term.setdefault(r["_term"], []).append(r["_t"])
    automaton = automaton_of(by_term)
    kind, ids = t.schema["_t"].dataType, list(by_term.values())
    shared = texts.sparkSession.sparkContext.broadcast((automaton, ids))
    weights = [w for _, w in places or []]
    d = texts.select(F.col(text_id).alias("_d"), F.col(text).alias("_text"), *[F.col(c).alias(f"_p{k}") for k, (c, _) in enumerate(places or [])]).where("_d IS NOT NULL AND _text IS NOT NULL")
    schema = StructType([StructField(text_id, d.schema["_d"].dataType), StructField(term_id, kind), *([StructField("location", DoubleType())] if places else [])])
    names, term_type = schema.names, to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, ids = shared.value
        if not ids:
            return

        def out(batch: pa.RecordBatch, rows: list, found: list, at: list) -> pa.RecordBatch:
            columns = [batch.column("_d").take(pa.array(np.concatenate(rows))), pa.array(found, term_type)]
            return pa.RecordBatch.from_arrays([*columns, *([pa.array(at, pa.float64())] if weights else [])], names)

        for batch in batches:
            rows, found, at = [], [], []
            fields = [batch.column(f"_p{k}").to_pylist() for k in range(len(weights))]
            for k, body in enumerate(batch.column("_text").to_pylist()):
                own = {n for _, n in automaton.iter(body)}
                place = dict.fromkeys(own, otherwise)
                for field, weight in reversed(list(zip(fields, weights, strict=True))):
                    place |= dict.fromkeys({n for _, n in automaton.iter(field[k])} & own if field[k] else (), weight)
                for n in own:
                    found += ids[n]
                    at += [place[n]] * len(ids[n])
                rows.append(np.full(sum(len(ids[n]) for n in own), k))
                if len(found) > 200_000:
                    yield out(batch, rows, found, at)
                    rows, found, at = [], [], []
            if found:
                yield out(batch, rows, found, at)

    return d.mapInArrow(run, schema)


def containment_by_grams(texts: DataFrame, terms: DataFrame, text_id: str, text: str, term_id: str, term: str, gram: int = 3) -> DataFrame:
    """(text_id, term_id): every term that occurs in a text.

    A theta join rewritten as an equi join: a term is looked up by its rarest character n-gram only, and verified. Terms shorter
    than n are looked up by themselves among the texts' shorter grams. A text meets all its candidates in one row.
    """
    t = terms.where(F.length(term) > 0).select(F.col(term_id).alias("_t"), F.col(term).alias("_term"))
    sizes = [r[0] for r in t.select(F.least(F.length("_term"), F.lit(gram))).distinct().collect()]
    d = texts.select(F.col(text_id).alias("_d"), F.col(text).alias("_text")).where("_d IS NOT NULL")
    grams = F.array_distinct(F.flatten(F.array(*[char_ngrams(F.col("_text"), n) for n in sorted(sizes)] or [F.array().cast("array<string>")])))
    cells = d.select("_d", F.explode(grams).alias("gram"))
    own = t.select("_t", "_term", F.explode(F.array_distinct(char_ngrams(F.col("_term"), gram))).alias("gram")).unionByName(t.where(F.length("_term") < gram).select("_t", "_term", F.col("_term").alias("gram")))
    wanted = cells.join(own.select("gram").distinct(), "gram", "left_semi")
    df = wanted.groupBy("gram").agg(F.count("*").alias("df"))
    rarest = own.join(df, "gram").groupBy("_t", "_term").agg(F.min_by("gram", F.struct("df", "gram")).alias("gram"))
    found = wanted.join(rarest, "gram")
    whole = found.where(F.col("_term") == F.col("gram")).select("_d", "_t")
    longer = found.where(F.col("_term") != F.col("gram")).groupBy("_d").agg(F.collect_list(F.struct("_t", "_term")).alias("_c")).join(d, "_d")
    longer = longer.select("_d", F.explode(F.filter("_c", lambda c: F.contains(F.col("_text"), c["_term"]))["_t"]).alias("_t"))
    return whole.unionByName(longer).select(F.col("_d").alias(text_id), F.col("_t").alias(term_id)).distinct()


def query_terms(queries: DataFrame, query_id: str, text: str, grams: dict[int, float], cap: int, stop: tuple[str, ...] = ()) -> DataFrame:
    """(query_id, term, weight): words at 1.0 and their character n-grams, the largest weight of each, the first ``cap``."""
    w = queries.select(query_id, F.explode(F.array_distinct(words(F.col(text)))).alias("word")).where(F.length("word").between(2, 40) & ~F.col("word").isin(*stop) if stop else F.length("word").between(2, 40))
    t = w.select(query_id, F.col("word").alias("term"), F.lit(1.0).alias("weight"))
    for n, weight in grams.items():
        t = t.unionByName(w.where(F.length("word") > n).select(query_id, F.explode(char_ngrams(F.col("word"), n)).alias("term"), F.lit(weight).alias("weight")))
    t = t.groupBy(query_id, "term").agg(F.max("weight").alias("weight"))
    rank = F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("weight"), F.desc(F.length("term")), "term"))
    return t.withColumn("_r", rank).where(F.col("_r") <= cap).drop("_r")


def idf_top_k(hits: DataFrame, terms: DataFrame, n_docs: int, query_id: str, doc_id: str, k: int) -> DataFrame:
    """(query_id, doc_id, score, rank) for hits (term, doc_id, location weight): sum of weight * location * ln(1 + N / df)."""
    # terms meet as numbers, and a hit has its whole part before it meets the queries
    known = cut(terms.select("term").distinct().withColumn("_n", F.monotonically_increasing_id()))
    hits = cut(hits.join(known, "term").select("_n", doc_id, "location"))
    df = hits.groupBy("_n").agg(F.count_distinct(doc_id).alias("df"))
    parts = hits.join(df, "_n").select("_n", doc_id, (F.col("location") * F.log(1 + F.lit(n_docs) / F.col("df"))).alias("_part"))
    s = terms.join(known, "term").select(query_id, "_n", "weight").join(parts, "_n").groupBy(query_id, doc_id).agg(F.sum(F.col("weight") * F.col("_part")).alias("score"))
    s = s.withColumn("score", F.round(F.col("score").cast("decimal(28,9)"), 3).cast("double"))
    rank = F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("score"), doc_id))
    return s.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k)


def containment_top_k(texts: DataFrame, terms: DataFrame, n_docs: int, query_id: str, doc_id: str, text: str, k: int, places: list[tuple[str, float]], otherwise: float = 1.0, letters: int = AUTOMATON_LETTERS, cells: int = SCORE_CELLS) -> DataFrame:
    """(query_id, doc_id, score, rank): what :func:`idf_top_k` gives for the hits of :func:`containment_join`, for terms (query_id, term, weight above 0).

    A hit meets each query that has its term, which is many rows where queries share their terms. So a text's hits are kept as one row of packed
    numbers, and a batch's scores are a product of two matrices, of which each query's best k of the batch go on. Terms of more than ``letters`` letters, a
    table of more than ``cells`` numbers and repeated ids of texts take the way over joined rows.
    """
    known = [r[0] for r in terms.where("term <> ''").select("term").distinct().orderBy("term").limit(cells + 1).collect()]
    asked = terms.select(query_id).distinct().count()
    ids = texts.where(F.col(doc_id).isNotNull()).groupBy(doc_id).count().where("count > 1")
    if not known or len(known) * asked > cells or sum(len(w) + 1 for w in known) > letters or not ids.isEmpty():
        hits = containment_join(texts, terms.select("term").distinct(), doc_id, text, "term", "term", letters=letters, places=places, otherwise=otherwise)
        return idf_top_k(hits, terms, n_docs, query_id, doc_id, k)
    spark = texts.sparkSession
    number = {w: n for n, w in enumerate(known)}
    rows = [(r[0], number[r[1]], float(r[2])) for r in terms.where("term <> ''").select(query_id, "term", "weight").collect()]
    queries = list(dict.fromkeys(q for q, _, _ in rows))
    at = {q: n for n, q in enumerate(queries)}
    table = np.zeros((len(known), len(queries)))
    for q, n, w in rows:
        table[n, at[q]] = w
    shared = spark.sparkContext.broadcast(automaton_of(known))
    weights, query_type, size = [w for _, w in places], to_arrow_type(terms.schema[query_id].dataType), len(known)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, second = shared.value, itemgetter(1)

        @lru_cache(100)
        def within(field: str) -> list[int]:
            return list(set(map(second, automaton.iter(field))))

        for batch in batches:
            fields = [batch.column(f"_p{n}").to_pylist() for n in range(len(weights))]
            packed, codes = [], []
            for i, body in enumerate(batch.column("_text").to_pylist()):
                own = np.array(sorted(set(map(second, automaton.iter(body)))), "<u4")
                code = np.full(len(own), len(weights), np.uint8)
                for c in range(len(weights) - 1, -1, -1):
                    if fields[c][i]:
                        code[np.isin(own, within(fields[c][i]))] = c
                packed.append(own.tobytes())
                codes.append(code.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("_d"), pa.array(packed, pa.binary()), pa.array(codes, pa.binary())], ["_d", "terms", "codes"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for batch in batches:
            n += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<u4"), minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n)), pa.array(n[n > 0])], ["n", "df"])

    columns = [F.col(c).alias(f"_p{n}") for n, (c, _) in enumerate(places)]
    d = texts.select(F.col(doc_id).alias("_d"), F.col(text).alias("_text"), *columns).where("_d IS NOT NULL AND _text IS NOT NULL")
    kind = d.schema["_d"].dataType
    d = d.repartition(2 * spark.sparkContext.defaultParallelism, "_d")  # tables in one row group are one task's otherwise
    hits = cut(d.mapInArrow(find, StructType([StructField("_d", kind), StructField("terms", BinaryType()), StructField("codes", BinaryType())])))
    idf = np.zeros(size)
    for n, df in hits.select("terms").mapInArrow(count, "n long, df long").groupBy("n").agg(F.sum("df")).collect():
        idf[n] = np.log(1 + n_docs / df)
    matrix = spark.sparkContext.broadcast((queries, table, np.outer([*weights, otherwise], idf)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, table, parts = matrix.value
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch.column("_d")))  # equal scores are in the order of ids
            own, codes = batch.column("terms").to_pylist(), batch.column("codes").to_pylist()
            sums = np.zeros((batch.num_rows, table.shape[1]))
            step = max(1, 1_000_000 // size)
            for a in range(0, len(own), step):
                x = np.zeros((min(step, len(own) - a), size))
                for r in range(len(x)):
                    t = np.frombuffer(own[a + r], "<u4")
                    x[r, t] = parts[np.frombuffer(codes[a + r], np.uint8), t]
                sums[a : a + step] = x @ table
            # thousandths, by way of nine places as in idf_top_k
            sums = np.where(sums > 0, (np.floor(sums * 1e9 + 0.5).astype(np.int64) + 500_000) // 1_000_000, -1)
            best = np.argsort(-sums, axis=0, kind="stable")[:k]
            q, r = np.broadcast_to(np.arange(table.shape[1]), best.shape).ravel(), best.ravel()
            q, r = q[sums[r, q] >= 0], r[sums[r, q] >= 0]
            yield pa.RecordBatch.from_arrays([pa.array([queries[n] for n in q.tolist()], query_type), batch.column("_d").take(pa.array(r)), pa.array(sums[r, q] / 1000.0)], [query_id, doc_id, "score"])

    s = hits.mapInArrow(score, StructType([StructField(query_id, terms.schema[query_id].dataType), StructField(doc_id, kind), StructField("score", DoubleType())]))
    rank = F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("score"), doc_id))
    return s.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k)


def bm25_top_k(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query_text: str, k: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(query_id, doc_id, score, rank): the inverted index keeps query terms only, document lengths are of all terms.

    Texts are split once: words outside the queries are counted together, so a document has a row for each of its query terms and one more.
    """
    q = queries.select(query_id, F.explode(F.array_distinct(words(F.col(query_text)))).alias("term"))
    vocabulary = q.select("term").distinct().withColumn("own", F.col("term"))
    every = docs.select(doc_id, F.explode_outer(words(F.col(text))).alias("term")).join(vocabulary, "term", "left")
    tf = cut(every.groupBy(doc_id, "own").agg(F.count("term").alias("tf")))
    lengths = cut(tf.groupBy(doc_id).agg(F.sum("tf").alias("len")))
    stats = lengths.agg(F.count("*").alias("n"), F.avg("len").alias("avg")).first()
    tf = tf.where("own IS NOT NULL").withColumnRenamed("own", "term")
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = df.select("term", F.log(1 + (F.lit(stats["n"]) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("len") / F.lit(stats["avg"] or 1.0))
    # a document's terms meet only in the queries that have them: partial sums before the shuffle
    s = tf.join(idf, "term").join(lengths, doc_id).select("term", doc_id, (F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + norm)).alias("part"))
    s = q.join(s, "term").groupBy(query_id, doc_id).agg(F.sum("part").alias("score")).withColumn("score", F.round("score", 6))
    rank = F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("score"), doc_id))
    return s.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k)
