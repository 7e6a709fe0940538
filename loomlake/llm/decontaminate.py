"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: a shard holds some whole documents, and for every term of theirs (64-bit hash of
the lower-cased word) the sorted list of positions where it stands. It is written to the shared folder in small rows and
small row groups, so that readers hold a few shards at a time. A query phrase is looked up in each shard: its terms are
ordered by their number of postings in the whole corpus, the rarest term's list gives possible starts, and the list of each
next term, shifted by its offset, is intersected with them. What is left are exact phrase matches. Proximity search keeps
the postings of the rarest term that have all other terms within a distance.

Only phrases are broadcast, in blocks of at most ``BLOCK_PHRASES``; every block is run against all shards. Statistics
over the corpus are summed for the terms of the block only. No shuffle carries postings, so neither frequent words nor
groups of copies make a hot task.

A document is known by its place, (shard, ordinal), and never by its id, so null, repeated and very large ids are safe, and the
number of blocks doesn't change the result.

Defined results: words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null text has no words; a
benchmark item of fewer words than the window is one window, an item without words none; repeated items each count; a null
item_id is the empty string; equal terms inside a phrase are intersected at their own offsets; an empty table on either side gives
no hits; a document has one row for each of its rows in the input, with its own id, null too; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, chunks, released, stored, table, text_bytes, word_hashes, word_spans

WINDOW = 10
BLOCK_PHRASES = 200_000
SHARD_BYTES = 250_000
#: Readers hold a row group at least; writers too.
SMALL_GROUPS = {"parquet.block.row.count.limit": "8", "parquet.enable.dictionary": "false"}
INDEX_SCHEMA = "shard long, doc_ids array<long>, doc_starts binary, terms binary, counts binary, positions binary"
FOUND = "shard long, ordinal int, doc_id long, n_words long, n_hit long, items array<string>, starts array<long>, stops array<long>"


def lower_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row and one more)."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets, ALNUM)
    return word_hashes(data, starts, ends), rows


def positional_index(docs: DataFrame) -> DataFrame:
    """One row per shard: documents, first position of each, terms, postings per term, positions by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in chunks(batch, "text", SHARD_BYTES):
                words, rows = lower_words(part.column("text"))
                order = np.argsort(words, kind="stable")
                terms, counts = np.unique(words[order], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column("doc_id")),
                        *(pa.array([x.tobytes()], pa.binary()) for x in (rows.astype("<i4"), terms, counts.astype("<i4"), order.astype("<i4"))),
                    ],
                    ["shard", "doc_ids", "doc_starts", "terms", "counts", "positions"],
                )
                shard += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda b: released(run(b)), INDEX_SCHEMA)


def bytes_of(column: pa.Array, k: int, kind: str) -> np.ndarray:
    """A binary value as numbers, without a copy."""
    return np.frombuffer(column[k].as_buffer(), kind)


class Shard:
    """One row of the index."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        self.shard = batch.column("shard")[k].as_py()
        self.doc_ids: pa.Array = batch.column("doc_ids")[k].values
        self.doc_starts = bytes_of(batch.column("doc_starts"), k, "<i4")
        self.terms = bytes_of(batch.column("terms"), k, "<u8")
        self.ends = np.cumsum(bytes_of(batch.column("counts"), k, "<i4").astype(np.int64))
        self.positions = bytes_of(batch.column("positions"), k, "<i4")

    def slots(self, terms: np.ndarray) -> np.ndarray:
        """Place of each term in the shard's dictionary, -1 where it has none."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, slot: int) -> np.ndarray:
        return self.positions[(self.ends[slot - 1] if slot else 0) : self.ends[slot]]

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, positions, side="right") - 1

    def phrase(self, slots: np.ndarray, by_rarity: np.ndarray) -> np.ndarray:
        """Starts of exact matches of a phrase, given its terms' slots and their order, the rarest first."""
        first = by_rarity[0]
        starts = self.postings(slots[first]) - first
        for k in by_rarity[1:]:
            if not len(starts):
                return starts
            own = self.postings(slots[k])
            at = np.minimum(np.searchsorted(own, starts + k), len(own) - 1)
            starts = starts[own[at] == starts + k]
        starts = starts[starts >= 0]
        return starts[self.doc_of(starts) == self.doc_of(starts + len(slots) - 1)]

    def near(self, slots: np.ndarray, by_rarity: np.ndarray, distance: int) -> np.ndarray:
        """Positions of the rarest term with every other term at most ``distance`` words away in the same document."""
        at = self.postings(slots[by_rarity[0]])
        for k in by_rarity[1:]:
            own = self.postings(slots[k])
            doc = self.doc_of(at)
            low = np.maximum(at - distance, self.doc_starts[doc])
            high = np.minimum(at + distance, self.doc_starts[doc + 1] - 1)
            at = at[np.searchsorted(own, high, side="right") > np.searchsorted(own, low, side="left")]
        return at


def phrases_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id string, terms array<long>): every window of every item, hashed as the index hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", SHARD_BYTES):
                words, rows = lower_words(part.column("text"))
                words = words.view(np.int64)
                ids, terms = [], []
                for i, item in enumerate(part.column("item_id").to_pylist()):
                    own = words[rows[i] : rows[i + 1]]
                    for k in range(max(1, len(own) - window + 1) if len(own) else 0):
                        ids.append(item)
                        terms.append(own[k : k + window])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(terms, pa.list_(pa.int64()))], ["item_id", "terms"])

    return items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").mapInArrow(run, "item_id string, terms array<long>")


def term_statistics(index: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """Postings in the whole corpus of each of the (sorted, bounded) terms."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                own, count = bytes_of(batch.column("terms"), k, "<u8"), bytes_of(batch.column("counts"), k, "<i4")
                at = np.minimum(np.searchsorted(shared.value, own), len(shared.value) - 1)
                hit = shared.value[at] == own
                total[at[hit]] += count[hit]  # a shard names each term once
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["k", "n"])

    got = index.select("terms", "counts").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    return {r["k"]: r["n"] for r in got}


class PhraseBlock:
    """Phrases, distinct, with their items, and each one's terms from the rarest in the corpus on."""

    def __init__(self, rows: list):
        by_terms: dict[tuple, set] = {}
        for r in rows:
            by_terms.setdefault(tuple(r["terms"]), set()).add(r["item_id"])
        self.items = [sorted(x) for x in by_terms.values()]
        self.phrases = [np.array(t, np.int64).view(np.uint64) for t in by_terms]
        self.terms = np.unique(np.concatenate(self.phrases)) if self.phrases else np.zeros(0, np.uint64)
        self.places = [np.searchsorted(self.terms, p) for p in self.phrases]
        self.by_rarity: list[np.ndarray] = []
        self.groups: list[tuple[int, np.ndarray, np.ndarray]] = []

    def order(self, statistics: dict[int, int]) -> None:
        n = np.array([statistics.get(k, 0) for k in range(len(self.terms))], np.int64)
        self.by_rarity = [np.argsort(n[p], kind="stable") for p in self.places]
        # phrases that hold a term with no posting anywhere match nothing
        live = [i for i, p in enumerate(self.places) if n[p].min() > 0]
        self.items, self.places, self.by_rarity = ([x[i] for i in live] for x in (self.items, self.places, self.by_rarity))
        # groups of equally long phrases, the terms of each from the rarest on, so that shards test them together
        for size in sorted({len(p) for p in self.places}):
            group = np.array([i for i, p in enumerate(self.places) if len(p) == size])
            self.groups.append((size, group, np.stack([self.places[i][self.by_rarity[i]] for i in group])))

    def present(self, slots: np.ndarray) -> Iterator[tuple[int, int]]:
        """(size, phrase) of the phrases all of whose terms a shard has."""
        for size, group, terms in self.groups:
            left = np.arange(len(group))
            for k in range(size):
                left = left[slots[terms[left, k]] >= 0]
            for i in group[left].tolist():
                yield size, i


def search(index: DataFrame, block: PhraseBlock) -> DataFrame:
    """Every document with its exact phrase matches of a block: hit words, items, and the hit intervals of words."""
    shared = index.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                shard = Shard(batch, k)
                slots = shard.slots(b.terms)
                n = len(shard.doc_ids)
                hit = np.zeros(len(shard.positions) + 1, np.int32)
                items: dict[int, set] = {}
                for size, i in b.present(slots):
                    starts = shard.phrase(slots[b.places[i]], b.by_rarity[i])
                    if len(starts):
                        np.add.at(hit, starts, 1)
                        np.add.at(hit, starts + size, -1)
                        for d in np.unique(shard.doc_of(starts)).tolist():
                            items.setdefault(d, set()).update(b.items[i])
                on = np.cumsum(hit[:-1]) > 0
                covered = np.concatenate([[0], np.cumsum(on)])
                first = shard.doc_starts.astype(np.int64)
                spans: dict[int, tuple[list, list]] = {}
                for d in items:
                    edge = np.diff(on[first[d] : first[d + 1]].astype(np.int8), prepend=0, append=0)
                    spans[d] = np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, shard.shard, np.int64)),
                        pa.array(np.arange(n, dtype=np.int32)),
                        shard.doc_ids,
                        pa.array(np.diff(first)),
                        pa.array(np.diff(covered[first]).astype(np.int64)),
                        pa.array([sorted(items.get(d, ())) for d in range(n)], pa.list_(pa.string())),
                        *(pa.array([spans[d][side] if d in spans else [] for d in range(n)], pa.list_(pa.int64())) for side in (0, 1)),
                    ],
                    ["shard", "ordinal", "doc_id", "n_words", "n_hit", "items", "starts", "stops"],
                )

    return index.mapInArrow(lambda b: released(run(b)), FOUND)


def proximity(index: DataFrame, words: list[str], distance: int) -> DataFrame:
    """(doc_id, position): where the rarest of the words has all others within ``distance`` words."""
    block = PhraseBlock([{"terms": [int(x) for x in lower_words(pa.array([w]))[0].view(np.int64)], "item_id": ""} for w in [" ".join(words)]])
    block.order(term_statistics(index, block.terms))
    shared = index.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                shard = Shard(batch, k)
                slots = shard.slots(b.terms)
                for _, i in b.present(slots):
                    at = shard.near(slots[b.places[i]], b.by_rarity[i], distance)
                    doc = shard.doc_of(at)
                    yield pa.RecordBatch.from_arrays([shard.doc_ids.take(pa.array(doc)), pa.array((at - shard.doc_starts[doc]).astype(np.int64))], ["doc_id", "position"])

    return index.mapInArrow(run, "doc_id long, position long")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_phrases: int = BLOCK_PHRASES) -> DataFrame:
    """(doc_id, n_words, n_hit, items) of every document, for all benchmark items.

    With more phrases than a block holds, phrases are dealt to blocks by a hash, and each block gives one row for each
    document that it hits; hit words are then counted over the union of the blocks' intervals, so they stay exact.
    """
    index = stored(positional_index(docs), "positional-index", **SMALL_GROUPS)
    phrases = stored(phrases_of(benchmark, window), "phrases")
    n = phrases.count()
    if n <= block_phrases:
        return search(index, loaded(index, phrases)).select("doc_id", "n_words", "n_hit", "items")
    parts = -(-n * 5 // (block_phrases * 4))
    hits = None
    for k in range(parts):
        block = loaded(index, phrases.where(F.pmod(F.xxhash64("terms"), F.lit(parts)) == k))
        found = stored(search(index, block).where("n_hit > 0").drop("doc_id", "n_words", "n_hit"), "phrase-hits")
        hits = found if hits is None else hits.unionByName(found)
    return merged(search(index, PhraseBlock([])), hits)


def loaded(index: DataFrame, phrases: DataFrame) -> PhraseBlock:
    """A block of phrases, their terms ordered by the corpus."""
    block = PhraseBlock(phrases.collect())
    block.order(term_statistics(index, block.terms) if len(block.terms) else {})
    return block


def merged(every: DataFrame, hits: DataFrame) -> DataFrame:
    """All documents with the blocks' hits; a document has a row for each block at most."""
    key = ["shard", "ordinal"]
    words = hits.select(*key, F.explode(F.arrays_zip("starts", "stops")).alias("s")).select(*key, F.explode(F.sequence(F.col("s.starts"), F.col("s.stops") - 1)).alias("at"))
    n_hit = words.distinct().groupBy(*key).agg(F.count("*").alias("n_hit"))
    items = hits.select(*key, F.explode("items").alias("item")).distinct().groupBy(*key).agg(F.array_sort(F.collect_list("item")).alias("items"))
    return (
        every.select(*key, "doc_id", "n_words")
        .join(n_hit, key, "left")
        .join(items, key, "left")
        .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark), d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT DISTINCT item, least(len(w), {WINDOW}) AS size, array_to_string(w[k:k + {WINDOW - 1}], ' ') AS g FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
z AS (SELECT DISTINCT size FROM t), g AS (SELECT doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') AS g FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS k FROM d, z WHERE len(w) >= size)),
h AS (SELECT doc_id, k, size, item FROM g JOIN t USING (size, g)), n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM h) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""
