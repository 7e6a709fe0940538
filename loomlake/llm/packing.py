"""Best-fit packing by hierarchical residual packing.

A document is its token ids and an end id. One longer than a sequence is cut into full sequences, its first piece being
the shorter rest; only the shorter pieces need packing. Every partition best-fits its own items, longest first, into the
fullest bin that has room, and emits the bins that are nearly full. If that leaves many items, the histograms of all open items' lengths
and of all open bins' rooms (at most a sequence's length of numbers each) tell which bins can still gain: a bin is emitted as it is if
no open item is as short as its room, and of the bins with one room only as many stay open as there are open items that short. What is left goes on to
a round on fewer partitions, the pieces of underfull bins as items again, so that long items of one partition meet short ones
of another; each partition also opens about the square root of its bins of short items only. A round has a partition for each
``PER_PARTITION`` open items, never fewer; the last is the one that needs a single partition, or follows a round that closed little.

Token ids equal those of the ``tokenizers`` library for the same file. Texts are cut at single spaces between other
characters, where its byte-level pattern always ends a token, and each distinct cut is tokenized once by ``tiktoken``
from the same vocabulary as ranks; a text with the vocabulary's special string or with other white space beside a space
is tokenized whole.

Defined results: null text counts as empty and is the end id alone; rows with equal ids are packed each on their own;
equal lengths are taken in any order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, cut, released, table

SEQUENCE = 1024
END_ID = 2
CACHE = 400_000  # distinct cuts kept by a Python worker
VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
ODD_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PER_PARTITION = 100_000  # items of a partition of any round, on average; a row is two longs
LITTLE, STALLED = 0.25, 0.75  # shares of open items: above the first, bins that can't gain are closed; above the second, all are in the next round
SLACK = 1  # room up to which a bin is nearly full
SPARE = 1.2  # open bins for each open item that fits into them

_tokenizers: dict = {}


class Known(dict):
    """Ids of cuts, as they are asked for; every cut but a text's first keeps the space before it. Cuts of the last generation are moved on when asked for again."""

    def __init__(self, encode: Callable[[str], list[int]], before: str):
        super().__init__()
        self.encode, self.before, self.last = encode, before, {}

    def __missing__(self, cut_: str) -> bytes:
        got = self.last.get(cut_)
        if got is None:
            got = array("I", self.encode(self.before + cut_)).tobytes()
        self[cut_] = got
        return got

    def age(self) -> None:
        self.last = dict(self)
        self.clear()


class CachedTokenizer:
    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.first, self.later = Known(self.encode, ""), Known(self.encode, " ")

    @staticmethod
    def simple(text: str) -> bool:
        """Whether every space stands alone between characters that are not white space."""
        return not ("  " in text or " \n" in text or "\n " in text or SPECIAL in text or ODD_SPACE.search(text))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.first) + len(self.later) > CACHE // 2:
            self.first.age()
            self.later.age()
        out, first, later, join = [], self.first, self.later.__getitem__, b"".join
        for t in texts:
            if not t:
                out.append(b"")
            elif self.simple(t):
                cuts = t.split(" ")
                out.append(join((first[cuts[0]], *map(later, cuts[1:]))))
            else:
                out.append(self.slow(t))
        return out

    def slow(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids if SPECIAL in text else self.encode(text)
        return array("I", ids).tobytes()


def tokenizer(vocabulary: str = VOCABULARY) -> CachedTokenizer:
    """One for each Python worker; its cache outlives tasks."""
    if vocabulary not in _tokenizers:
        _tokenizers[vocabulary] = CachedTokenizer(vocabulary)
    return _tokenizers[vocabulary]


def pieces(docs: DataFrame, sequence: int = SEQUENCE, end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): tokenized documents, cut to the sequence length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            for part in chunks(batch, "text"):
                rows: list[tuple] = []
                ids = tokenizer(vocabulary).ids([t or "" for t in part.column("text").to_pylist()])
                for doc, own in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    own += end
                    n = len(own) // 4
                    at, k = 0, 0
                    while at < n:
                        stop = at + ((n - 1) % sequence + 1 if not k else sequence)
                        rows.append((doc, k, at, stop - at, zlib.crc32(own[4 * at : 4 * stop])))
                        at, k = stop, k + 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], PIECES.replace(",", "").split()[::2])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda b: released(run(b)), PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin and place of each item, room left in each bin): longest first, each into the fullest bin that has room."""
    bin_of, place = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[int] = []
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by room
    have = 0  # bit r: some bin has room r
    order = np.argsort(-lengths, kind="stable")
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = have >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = stacks[r].pop()
            if not stacks[r]:
                have &= ~(1 << r)
        else:
            b, r = len(room), capacity
            room.append(r)
        bin_of[i], place[i] = b, capacity - r
        room[b] = r - size
        if r > size:
            stacks[r - size].append(b)
            have |= 1 << (r - size)
    return bin_of, place, room


def _round(items: DataFrame, capacity: int, slack: int) -> DataFrame:
    """Best-fit each partition's items (item, fill): (item, fill, bin, place, room, closed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [pa.RecordBatch.from_arrays([b.column("item"), b.column("fill")], ["item", "fill"]) for b in batches if b.num_rows]
        if not got:
            return
        item = np.concatenate([b.column("item").to_numpy(zero_copy_only=False) for b in got])
        fill = np.concatenate([b.column("fill").to_numpy(zero_copy_only=False) for b in got])
        order = np.lexsort((item, -fill))  # a run again gives the same bins
        item, fill = item[order], fill[order]
        bin_of, place, room = best_fit(fill, capacity)
        rooms = np.array(room, np.int64)
        closed = rooms <= slack
        if slack < capacity:
            large = np.zeros(len(rooms), bool)
            large[bin_of[fill > capacity // 2]] = True
            # other partitions may lack small items: some bins of small items only are opened again
            spare = np.flatnonzero(closed & ~large)[-int(np.ceil(np.sqrt(len(rooms)))) :]
            closed[spare] = False
        lead = np.zeros(len(rooms), np.int64)
        lead[bin_of[place == 0]] = item[place == 0]  # a bin is named by its first item
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (item, fill, lead[bin_of], place, rooms[bin_of], closed[bin_of])], ["item", "fill", "bin", "place", "room", "closed"])

    return items.mapInArrow(run, "item long, fill long, bin long, place long, room long, closed boolean")


def can_gain(done: DataFrame, capacity: int) -> Column:
    """Which open bins of a round stay open: those that an open item may still fill, as far as such items go."""
    kept = np.full(capacity + 1, 1_000_000)  # of a million, by room
    part = F.pmod(F.xxhash64("bin"), F.lit(1_000_000))
    stays = lambda: ~F.col("closed") & (part < F.array(*map(F.lit, kept.tolist()))[F.col("room").cast("int")])
    for _ in range(4):  # what is closed takes its items with it, so others may have nothing to gain then
        rows = done.where(stays()).groupBy("fill", "room").agg(F.count("*").alias("items"), F.sum((F.col("place") == 0).cast("long")).alias("bins"))
        # two histograms, not their product
        short, bins = np.zeros(capacity + 1), np.zeros(capacity + 1)
        for r in rows.groupBy("fill").agg(F.sum("items").alias("n")).collect():
            short[r["fill"]] = r["n"]
        for r in rows.groupBy("room").agg(F.sum("bins").alias("n")).collect():
            bins[r["room"]] = r["n"]
        share = np.minimum(1, SPARE * np.cumsum(short) / np.maximum(bins, 1))
        was, kept = kept, np.where(share < 1, np.floor(kept * share), kept).astype(np.int64)
        if (bins[kept < was] == 0).all():
            break
    return stays()


def pack(items: DataFrame, capacity: int = SEQUENCE, per_partition: int = PER_PARTITION) -> DataFrame:
    """(item, sequence_id, offset) for items (item long, distinct; fill long, from 1 to capacity)."""
    left, out, turn, stalled = items.count(), None, 0, False
    while True:
        parts = max(1, -(-left // per_partition))
        final = parts == 1 or stalled
        done = cut(_round(items.repartition(parts, F.xxhash64("item", F.lit(turn))), capacity, capacity if final else SLACK))
        stays = F.lit(False) if final else ~F.col("closed")
        rest = 0 if final else done.where(stays).count()
        if rest > max(per_partition, LITTLE * left):
            stays = can_gain(done, capacity)
            rest = done.where(stays).count()
        full = done.where(~stays).select("item", F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
        out = full if out is None else out.unionByName(full)
        if not rest:
            return out
        items = done.where(stays).select("item", "fill")
        stalled, left, turn = rest > STALLED * left, rest, turn + 1


def pack_documents(docs: DataFrame, sequence: int = SEQUENCE, end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``."""
    cuts = cut(pieces(docs, sequence, end_id, vocabulary).withColumn("item", F.monotonically_increasing_id()))
    full = cuts.where(F.col("length") == sequence).select(*PIECES.replace(",", "").split()[::2], F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    small = cuts.where(F.col("length") < sequence)
    places = pack(small.select("item", F.col("length").alias("fill")), sequence)
    return small.join(places, "item").select(full.columns).unionByName(full)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
