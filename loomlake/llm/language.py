"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text is built for every language. A text is parsed greedily against each automaton:
the longest piece that occurs in the labelled text is a phrase, and the next phrase begins after it. The number of
phrases times log2 of the labelled text's length, over the text's length, estimates the cross entropy in bits a
letter; the language needing fewest such normalised phrases wins.

All windows of a batch are parsed in lockstep by numpy. The automata's transitions lie in one array, the rows of the states
displaced so that they interlock (``Transitions``): every learned letter of any script can match, and the model has a few
bytes a learned letter. Whole texts are parsed, in windows of ``WINDOW`` letters (a phrase ends with its window, for all
languages alike).

The model is fitted on at most ``TRAIN_CHARS`` letters a language and ``TRAIN_ROWS`` rows a language (in order of a
hash of doc_id, of longer texts the first ``TRAIN_TEXT`` characters, each distinct text once); the bound does not grow with the
rows, and nothing but these rows comes to the driver. It grows with the number of languages, each value of ``lang`` being one.

Defined results: null text and text without letters give ``und`` and score 0; rows with a null language are not
learned from; with no labelled rows all is ``und``; equal counts go to the alphabetically first language with score
0; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, give_back, released, table

WINDOW = 512
TRAIN_CHARS, TRAIN_ROWS, TRAIN_TEXT = 50_000, 200, 20_000
SCHEMA = "doc_id long, lang_pred string, score double, bits double"


def suffix_automaton(seq: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of ``seq``; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in seq:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Transitions:
    """Transitions of all states in one array: state s goes by letter c to ``target[base[s] + c]`` if ``owner`` there is s."""

    def __init__(self, states: int, frm: np.ndarray, letter: np.ndarray, to: np.ndarray, letters: int):
        """Of transitions (frm, letter, to), sorted by frm."""
        total = len(frm)
        first = np.searchsorted(frm, np.arange(states + 1))
        degree = np.diff(first)
        span = total * 8 // 5 + 64
        slots = np.zeros(span + letters, bool)
        self.base = np.zeros(states, np.int32)
        places = np.random.default_rng(states)
        # states of several letters at a random place where they fit, those of one letter into the holes
        many = np.flatnonzero(degree > 1)
        for s in many[np.argsort(-degree[many], kind="stable")].tolist():
            own, tries = letter[first[s] : first[s + 1]], 0
            while True:
                at = places.integers(0, span, 16)
                fits = np.flatnonzero(~slots[at[:, None] + own[None, :]].any(axis=1))
                if len(fits):
                    break
                tries += 1
                if tries % 64 == 0:
                    slots = np.concatenate([slots, np.zeros(span // 4, bool)])
                    span += span // 4
            self.base[s] = at[fits[0]]
            slots[self.base[s] + own] = True
        ones = np.flatnonzero(degree == 1)
        holes = np.flatnonzero(~slots[letters:])[: len(ones)] + letters
        if len(holes) < len(ones):
            holes = np.concatenate([holes, np.arange(len(slots), len(slots) + len(ones) - len(holes))])
        self.base[ones] = holes - letter[first[ones]]
        at = self.base[frm] + letter
        size = int(at.max(initial=0)) + letters + 1  # any state may be asked for any letter
        self.owner, self.target = np.full(size, -1, np.int32), np.zeros(size, np.int32)
        self.owner[at], self.target[at] = frm, to

    def __call__(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none."""
        at = self.base[state] + letter
        return np.where(self.owner[at] == state, self.target[at], -1)


class CrossParser:
    """Languages, letter table and the transitions of all automata."""

    def __init__(self, texts: dict[str, list[str]], limit: int = TRAIN_CHARS):
        self.langs = sorted(texts)
        letters: Counter[str] = Counter()
        for lang in self.langs:
            for t in texts[lang]:
                letters.update(t.lower())
        known = [c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0])) if c.isalpha()]
        self.size = len(known) + 2  # 0: between words, last: letters that were never learned
        code = np.zeros(0x110000, np.uint16 if self.size < 2**16 else np.int32)
        own = {c: i + 1 for i, c in enumerate(known)}
        for p in range(0x110000):
            c = chr(p)
            if c.isalpha():
                low = c.lower()
                code[p] = own.get(low[0] if low else c, self.size - 1)
        self.code = code
        states, arcs = 0, []
        self.weights, roots = [], []
        for lang in self.langs:
            seq: list[int] = []
            for t in texts[lang]:
                seq += self.symbols(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4")).tolist()
                seq.append(0)
                if len(seq) >= limit:
                    break
            seq = seq[:limit] or [0]
            roots.append(states)
            automaton = suffix_automaton(seq)
            own = np.array([(s, c, to) for s, d in enumerate(automaton) for c, to in d.items() if c != self.size - 1], np.int64).reshape(-1, 3)
            arcs.append(own + np.array([states, 0, states]))
            states += len(automaton)
            self.weights.append(math.log2(len(seq) + 1))
        self.roots = np.array(roots, np.int32)
        frm, letter, to = np.concatenate(arcs).T if arcs else np.zeros((3, 0), np.int64)
        self.next = Transitions(states, frm, letter, to, self.size)
        self.again = np.repeat(self.roots[:, None], self.size, axis=1)  # where a phrase that begins with a letter stands
        for k, root in enumerate(roots):
            self.again[k, letter[frm == root]] = to[frm == root]
        self.unknown = self.again == self.roots[:, None]  # a letter that never occurs is a phrase of its own

    def symbols(self, points: np.ndarray) -> np.ndarray:
        s = self.code[points]
        keep = s != 0
        keep[1:] |= s[:-1] != 0
        return s[keep]

    def phrases(self, seq: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Phrases of each piece ``seq[bounds[i]:bounds[i+1]]`` under each language: (pieces, languages)."""
        lens = np.diff(bounds)
        n_win = -(-lens // WINDOW)
        owner = np.repeat(np.arange(len(lens)), n_win)
        first = np.cumsum(n_win) - n_win
        starts = bounds[:-1][owner] + (np.arange(len(owner)) - first[owner]) * WINDOW
        stops = np.minimum(starts + WINDOW, bounds[1:][owner])
        order = np.argsort(starts - stops, kind="stable")  # the longest first
        starts, owner, size = starts[order], owner[order], (stops - starts)[order]
        padded = np.concatenate([seq, np.zeros(WINDOW, seq.dtype)])
        langs = len(self.langs)
        count = np.zeros((langs, len(starts)), np.int32)
        state = np.repeat(self.roots[:, None], len(starts), axis=1)
        active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
        for t, n in enumerate(active):
            c = padded[starts[:n] + t]
            to = self.next(state[:, :n], c)
            dead = to < 0
            count[:, :n] += dead & (state[:, :n] != self.roots[:, None])
            count[:, :n] += self.unknown[:, c]
            state[:, :n] = np.where(dead, self.again[:, c], to)
        count += state != self.roots[:, None]
        out = np.zeros((len(lens), langs))
        for k in range(langs):
            out[:, k] = np.bincount(owner, weights=count[k], minlength=len(lens))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        texts = [t if t is None or t.isascii() or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t) for t in texts]
        seqs, letters = [], []
        for t in texts:
            s = self.symbols(np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), "<u4"))
            seqs.append(s)
            letters.append(bool(s.any()))
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in seqs])]).astype(np.int64)
        if not self.langs or not any(letters):
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        bits = self.phrases(np.concatenate(seqs), bounds) * np.array(self.weights) / np.maximum(np.diff(bounds), 1)[:, None]
        best = bits.argmin(axis=1)
        ranked = np.sort(bits, axis=1)
        score = 1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1e-12) if bits.shape[1] > 1 else np.ones(len(texts))
        ok = np.array(letters)
        return [self.langs[b] if y else "und" for b, y in zip(best, ok, strict=True)], np.where(ok, np.clip(score, 0, 1), 0.0), np.where(ok, ranked[:, 0], 0.0)


def labelled_sample(rows: DataFrame) -> dict[str, list[str]]:
    """Texts to learn from by language, out of rows (doc_id, text, lang); bounded as the module says."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    key = F.xxhash64(F.col("doc_id").cast("string"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    wanted = None
    for lang, n in counts.items():  # on average twice the rows of the bound
        near = F.col("lang").eqNullSafe(F.lit(lang)) & (key < F.lit(min(2**63 - 1, -(2**63) + 2**64 * 2 * TRAIN_ROWS // n)))
        wanted = near if wanted is None else wanted | near
    got = rows.where(wanted).select("lang", key.alias("h"), "doc_id", F.substring("text", 1, TRAIN_TEXT).alias("text"))
    texts: dict[str, list[str]] = {}
    for r in sorted(got.collect(), key=lambda r: (r["h"], str(r["doc_id"]))):
        own = texts.setdefault(r["lang"], [])
        if len(own) < TRAIN_ROWS and r["text"] not in own:
            own.append(r["text"])
    return texts


def fit(rows: DataFrame) -> CrossParser:
    model = CrossParser(labelled_sample(rows))
    give_back()
    return model


def identify(docs: DataFrame, model: CrossParser) -> DataFrame:
    """(doc_id, lang_pred, score, bits) of every whole text; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                langs, score, bits = shared.value.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())], ["doc_id", "lang_pred", "score", "bits"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda b: released(run(b)), SCHEMA)


def labelled(docs: DataFrame, model: CrossParser) -> DataFrame:
    """``docs`` with ``lang`` replaced by the prediction; no shuffle of the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                langs, _, _ = shared.value.predict(part.column("text").to_pylist())
                yield part.set_column(part.schema.get_field_index("lang"), "lang", pa.array(langs, pa.string()))

    return docs.mapInArrow(lambda b: released(run(b)), docs.schema)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
