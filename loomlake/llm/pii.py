"""Personal data: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The patterns (``base_spans``) find e-mail addresses, IP addresses, card and phone numbers. The random field works on
words, their shapes and the cue words before them; it is trained on the driver from a small labelled table (``training_table``,
made by rule from common written forms) by gradient ascent on the regularised likelihood, and decoded by Viterbi in numpy batches.
It adds credentials (``secret``: keys, tokens, passwords), numbers of persons (``id``: national and passport numbers, bank accounts), phone numbers
without a country code, written-out e-mail addresses and grouped card numbers. A span that overlaps one of a pattern is dropped, the patterns' spans
stay.

Every word of every text is scored and may get any label. Words of one context (traits of a word and its neighbours, cue words before) have
equal scores, so each context is scored once. Viterbi then skips the words that no best path labels (``Contexts.open`` has the
proof): these are outside for sure, the chain falls apart there, and decoding the rest gives what decoding whole texts gives.

Defined results: null and empty texts have no spans; repeated rows get equal results; matches that fail their test
are dropped without a retry; offsets are code points, ends exclusive; spans of one start are in the order of ``KINDS``; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, give_back, released, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "id")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS if k != "ip" for p in "BI"))
BACK = 4  # words before a word that its features look at
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base array<struct<kind:string,start:long,end:long>>, added array<struct<kind:string,start:long,end:long>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
#: A match that fails from the first digit of a run fails from its later digits too.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, str, int]  # start, kind, end


def luhn(digits: str) -> bool:
    odd = digits[::-1]
    return (sum(map(int, odd[::2])) + sum(sum(divmod(2 * int(c), 10)) for c in odd[1::2])) % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost, non-overlapping; from each at-sign back and on, so the work is linear."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, "email", m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if "@" in text:
        out += emails(text)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.groups()):
                out.append((m.start(), "ip", m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "") if m.end() - m.start() <= 40 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), "card", m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    out.append((m.start(), "phone", m.end()))
    out.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    return out


# --- words, shapes, features ---

#: Words that tell what is beside them: fixed values, by meaning.
CUES = {
    "phone": "call phone tel telephone telefon teléfono téléphone handy fax mobile mobil cell text reach whatsapp ring sms anruf appelez llame",
    "card": "card visa mastercard amex credit debit karte kreditkarte carte tarjeta pan",
    "mail": "email mail e-mail contact write correo courriel kontakt address",
    "secret": "token secret key apikey api_key api-key access_key secret_key password passwd pwd passwort kennwort contraseña clave credential credentials bearer auth authorization auth_token access_token client_secret private_key pass",
    "id": "ssn social security passport passeport reisepass pasaporte iban dni nie nif national identity licence license insurance konto account",
    "number": "order invoice version build page room item part serial isbn year no number nr article section chapter vol volume ticket case ref figure table rev since until from to",
    "hash": "commit sha sha1 sha256 md5 hash checksum digest etag uuid guid revision blob crc",
    "net": "ip host server",
    "at": "at [at] (at) {at}",
    "dot": "dot [dot] (dot) {dot}",
}
_CUE = {w: k for k, words in CUES.items() for w in words.split()}
_WORD = re.compile(r"\S+")
_RUN = re.compile(r"[0-9]+|[A-Z]+|[a-z]+|[^0-9A-Za-z]")
_NAMED = re.compile(r"[A-Za-z][\w.-]*[=:](?=.)")
_TRIM = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


@lru_cache(20_000)
def shape(word: str) -> str:
    """Runs of digits with their length, of letters without; other characters as they are; at most 12 runs."""
    out = []
    for m in _RUN.finditer(word[:64]):
        c, n = m.group()[0], m.end() - m.start()
        out.append(f"d{min(n, 20)}" if c.isdigit() and c.isascii() else "X" if "A" <= c <= "Z" else "x" if "a" <= c <= "z" else c if c.isascii() else "u")
        if len(out) == 12:
            break
    return "".join(out)


@lru_cache(20_000)
def form(word: str) -> str:
    """What characters a word has between its quotes and marks, and about how many."""
    w = word.strip(_TRIM)
    if m := _NAMED.match(w):
        w = w[m.end() :].strip(_TRIM)
    n, digits = len(w), sum("0" <= c <= "9" for c in w)
    size = str(n) if n <= 12 else f"{n // 8 * 8}+"
    if not digits:
        return "word" if n and w.isalpha() else "mark" if not n else "long" if n > 20 else "other"
    if digits == n:
        return "d" + size
    if all(c in "0123456789abcdefABCDEF" for c in w):
        return "hex" + (size if n > 12 else "")
    if all(c.isascii() and c.isalnum() for c in w):
        return ("upper" if w.upper() == w else "mix") + size
    if all(c in "0123456789-./()" for c in w):
        return "num" + size
    return "key" + size if n >= 16 and all(c.isascii() and (c.isalnum() or c in "-_+/=.~") for c in w) else "odd"


@lru_cache(20_000)
def cue(word: str) -> str:
    """The meaning of a cue word; of a name that is given a value by ``=`` or ``:`` in the same word too."""
    w = word.strip(".,;!?#%$*&").lower()
    if w in _CUE:
        return _CUE[w]
    bare = w.strip("()[]{}\"':=<>`")
    if bare in _CUE:
        return _CUE[bare]
    head, sign, value = re.match(r"([^=:]*)([=:]?)(.*)", bare, re.S).groups()
    if sign and value:
        head = head.strip(_TRIM)
        return "=" + _CUE.get(head, _CUE.get(re.split("[_.-]", head)[-1], "")) if head else ""
    return _CUE.get(re.split("[_-]", bare)[-1], "") if "_" in bare else ""


@lru_cache(20_000)
def traits(word: str) -> tuple[str, str, str, str]:
    return shape(word.rstrip(".,;:!?#%$*&")), form(word), cue(word), shape(word)


Traits = tuple[str, str, str, str]
START, STOP = ("<s>",) * 4, ("</s>",) * 4


def described(word: Traits, before: Traits, after: Traits, near: str, number: bool) -> list[str]:
    """Features of a word by its context; ``near``: the nearest cue before and its distance."""
    core, own, said, _ = word
    kind = near[:-1]
    return ["s:" + core, "k:" + own, "c:" + said, "n:" + near, "p:" + before[3], "pk:" + before[1], "f:" + after[0], "fk:" + after[1], f"sn:{core}|{kind}", f"kn:{own}|{kind}", f"sp:{core}|{before[0]}", f"sf:{core}|{after[0]}", f"kc:{own}|{said}", f"no:{number}|{kind}", "b"]


def features(words: list[str], i: int) -> list[str]:
    before = traits(words[i - 1]) if i else START
    after = traits(words[i + 1]) if i + 1 < len(words) else STOP
    near = next((f"{c}{k}" for k in range(1, BACK) if i - k >= 0 and (c := traits(words[i - k])[2]) not in ("", "number")), "")
    number = any(i - k >= 0 and traits(words[i - k])[2] == "number" for k in (1, 2))
    return described(traits(words[i]), before, after, near, number)


class RandomField:
    """Weights of word features and label pairs."""

    def __init__(self, names: dict[str, int]):
        self.names = names
        self.emit = np.zeros((len(names) + 1, len(LABELS)))  # the last row: unknown features
        self.pair = np.zeros((len(LABELS), len(LABELS)))
        allowed = np.array([[not b.startswith("I-") or a[1:] == b[1:] and a != "O" for b in LABELS] for a in LABELS])
        self.barred = np.where(allowed, 0.0, -1e4)
        self.first = np.array([-1e4 if b.startswith("I-") else 0.0 for b in LABELS])

    def scores(self, words: list[str]) -> np.ndarray:
        """A row for each word."""
        return self.rows([features(words, i) for i in range(len(words))])

    def rows(self, described: list[list[str]]) -> np.ndarray:
        unknown, get = len(self.names), self.names.get
        return self.emit[[[get(f, unknown) for f in own] for own in described]].sum(axis=1) if described else np.zeros((0, len(LABELS)))

    def viterbi(self, emits: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each sequence; equally long ones (padded) go together."""
        out: list = [None] * len(emits)
        by_size: dict[int, list[int]] = {}
        for i, e in enumerate(emits):
            by_size.setdefault(max(4, 1 << (len(e) - 1).bit_length()), []).append(i)
        move = self.pair + self.barred
        for ids in by_size.values():
            for at in range(0, len(ids), 4096):
                own = ids[at : at + 4096]
                lens = np.array([len(emits[i]) for i in own])
                x = np.zeros((len(own), lens.max(), len(LABELS)))
                for r, i in enumerate(own):
                    x[r, : lens[r]] = emits[i]
                best, back = x[:, 0] + self.first, np.zeros(x.shape, np.int8)
                for t in range(1, x.shape[1]):
                    s = best[:, :, None] + move
                    back[:, t] = s.argmax(axis=1)
                    on = (t < lens)[:, None]
                    best = np.where(on, s.max(axis=1) + x[:, t], best)
                    back[:, t] = np.where(on, back[:, t], np.arange(len(LABELS)))
                y = np.zeros(x.shape[:2], np.int8)
                y[:, -1] = best.argmax(axis=1)
                for t in range(x.shape[1] - 1, 0, -1):
                    y[:, t - 1] = back[np.arange(len(own)), t, y[:, t]]
                for r, i in enumerate(own):
                    out[i] = y[r, : lens[r]]
        return out


class Contexts:
    """Scores of a random field by context, kept between batches."""

    #: Words and contexts that are kept; beyond, all are forgotten before the next batch.
    KEPT = 100_000
    CUES = ("", *(k for k in CUES if k != "number"), "=", *("=" + k for k in CUES))

    class Numbers(dict):
        """Number of a word's traits; no word is a blank or a line end."""

        def __init__(self) -> None:
            super().__init__({" ": 0, "\n": 1})
            self.traits, self.cue, self.number, self.known = [START, STOP], [0, 0], [False, False], {START: 0, STOP: 1}

        def __missing__(self, word: str) -> int:
            bare = word[:-1] if word[-1] in ".,;:!?" else word
            if 2 <= len(bare) < 60 and bare.isascii() and bare.isalpha() and (bare.islower() or bare.istitle()) and bare.lower() not in _CUE:
                # plain words differ by their first letter and their mark only
                plain = ("xx" if bare.islower() else "Xx") + word[len(bare) :]
                if plain != word:
                    n = self[word] = self[plain]
                    return n
            own = traits(word)
            n = self[word] = self.known.setdefault(own, len(self.known))
            if n == len(self.traits):
                self.traits.append(own)
                self.cue.append(0 if own[2] == "number" else Contexts.CUES.index(own[2]))
                self.number.append(own[2] == "number")
            return n

    def __init__(self, crf: RandomField):
        self.crf = crf
        move = crf.pair + crf.barred
        plain = [not y.startswith("I-") for y in LABELS]
        #: (label that begins a span, label that goes on, most that the pairs around and at the begin of a span gain over O, what each further pair gains)
        self.kinds = []
        for b in range(1, len(LABELS), 2):
            i = b + 1
            into = max((move[:, b] - move[:, 0]).max(), crf.first[b] - crf.first[0])
            out = max(0.0, (move[[b, i]] - move[0])[:, plain].max())
            self.kinds.append((b, i, into + out + max(0.0, move[b, i] - move[i, i]), move[i, i] - move[0, 0]))
        self.forget()

    def forget(self) -> None:
        self.numbers, self.seen, self.table = Contexts.Numbers(), {}, np.zeros((0, len(LABELS)))

    def open(self, rows: np.ndarray, own: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """Which of ``size`` places (words ``at`` with scores ``rows[own]``) lie in a span that may be worth its labels.

        Making a span of a path all O leaves a valid path. What that loses is the span's gain: its scores and pairs, those with its neighbours included, over
        the scores and pairs of O. So no best path has a span of negative gain. The greatest gain of a span around a word is bounded by the
        best begin up to the word and the best end from it on, which are running maxima over sums of scores.
        """
        out = np.zeros(size, bool)
        gain = rows - rows[:, :1]
        for b, i, around, on in self.kinds:
            begin, more = np.full(size, -1e4), np.full(size, -1e4)  # no word: no span
            begin[at], more[at] = gain[own, b] + around, gain[own, i] + on
            total = np.cumsum(more)
            out |= np.maximum.accumulate(begin - total) + np.maximum.accumulate(total[::-1])[::-1] >= -1e-3
        return out

    def labels(self, texts: list[str]) -> dict[int, np.ndarray]:
        """Best labels of the words of each text that has any but O."""
        if max(len(self.numbers), len(self.seen)) > self.KEPT:
            self.forget()
        flat: list[str] = []
        starts, sizes = [], []
        for t in texts:
            words = t.split()
            flat += [" "] * (BACK - 1)
            starts.append(len(flat))
            sizes.append(len(words))
            flat += words
            flat.append("\n")
        n = np.fromiter(map(self.numbers.__getitem__, flat), np.int64, len(flat))
        del flat
        cue, number = np.array(self.numbers.cue)[n], np.array(self.numbers.number)[n]
        near, told = np.zeros_like(n), np.zeros(len(n), bool)
        for k in range(BACK - 1, 0, -1):
            near[k:] = np.where(cue[:-k] > 0, cue[:-k] * BACK + k, near[k:])
        for k in (1, 2):
            told[k:] |= number[:-k]
        at = np.flatnonzero(n > 1)
        if not len(at):
            return {}
        code = lambda keys: pa.array(keys).dictionary_encode().indices.to_numpy().astype(np.int64)
        size = len(self.numbers.traits)
        own = code(((code(n[at - 1] * size + n[at]) * size + n[at + 1]) * (len(self.CUES) * BACK) + near[at]) * 2 + told[at])
        first = np.zeros(own.max() + 1, np.int64)
        first[own[::-1]] = at[::-1]
        rows = self.rows(list(zip(n[first - 1].tolist(), n[first].tolist(), n[first + 1].tolist(), near[first].tolist(), told[first].tolist(), strict=True)))
        unsure = self.open(rows, own, at, len(n))[at]
        row = np.full(len(n), -2)  # no word
        row[at] = -1  # outside
        row[at[unsure]] = own[unsure]
        spots = at[unsure]
        out: dict[int, np.ndarray] = {}
        if not len(spots):
            return out
        cuts = np.flatnonzero(np.diff(spots) > 1) + 1
        lows, highs = spots[np.r_[0, cuts]], spots[np.r_[cuts - 1, len(spots) - 1]]
        lows, highs = lows - (row[lows - 1] == -1), highs + (row[highs + 1] == -1)  # with the words outside beside them
        rows = np.concatenate([rows, [[0.0] + [-1e6] * (len(LABELS) - 1)]])
        found = self.crf.viterbi([rows[row[a : b + 1]] for a, b in zip(lows.tolist(), highs.tolist(), strict=True)])
        for low, y in zip(lows.tolist(), found, strict=True):
            if y.any():
                i = int(np.searchsorted(starts, low, side="right")) - 1
                out.setdefault(i, np.zeros(sizes[i], np.int8))[low - starts[i] : low - starts[i] + len(y)] |= y
        return out

    def rows(self, keys: list[tuple[int, int, int, int, bool]]) -> np.ndarray:
        """Scores of contexts: numbers of the words before, at and after, the nearest cue, whether a number is told."""
        new = [k for k in keys if k not in self.seen]
        if new:
            t = self.numbers.traits
            cue = lambda near: f"{self.CUES[near // BACK]}{near % BACK}" if near else ""
            fresh = [self.crf.rows([described(t[k[1]], t[k[0]], t[k[2]], cue(k[3]), k[4]) for k in new[a : a + 4096]]) for a in range(0, len(new), 4096)]
            self.seen.update((k, len(self.table) + i) for i, k in enumerate(new))
            self.table = np.concatenate([self.table, *fresh])
        return self.table[[self.seen[k] for k in keys]]


def training_table(rows: int = 1000, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """Labelled sentences (words, labels), made by rule: common written forms of personal data among plain words, and other numbers."""
    r = random.Random(seed)
    syllables = "an be da en for ing lo mi na or pa re so ti un wh ver ción eau sch the of and que der les".split()
    mark = lambda: r.choice(["", "", "", "", ",", ".", "!", "###", "%"])
    plain = lambda n: ["".join(r.choices(syllables, k=r.randint(1, 4))) + mark() for _ in range(n)]
    d = lambda n: "".join(r.choices("0123456789", k=n))
    some = lambda chars, n: "".join(r.choices(chars, k=n))
    name = lambda: "".join(r.choices(syllables[:16], k=2))
    letters, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    quoted = lambda x: (q := r.choice(["", "", '"', "'"])) + x + q

    def key() -> str:
        n = r.choice([16, 20, 24, 32, 36, 40, 40, 48, 64])
        chars = r.choice(["0123456789abcdef", "0123456789abcdef", "0123456789ABCDEF", letters + "0123456789", upper + "0123456789", letters + upper + "0123456789"])
        return r.choice(["", "", "", "sk-", "pk_", "ghx_"]) + some(chars, n)

    def password() -> str:
        return some(letters + upper, r.randint(3, 7)) + d(r.randint(1, 4)) + r.choice(["", "!", "#x", "_a"])

    def phrase(*words: str):
        """Words of which those in <> are labelled."""
        return lambda: [w() if callable(w) else w for w in words]

    P = lambda f: lambda: ("B", f())
    tel, mail, pay, sec, idn = (lambda w=w: r.choice(w) for w in (["call", "phone", "tel:", "Tel", "mobile", "fax:", "ring", "reach", "Phone:", "whatsapp"], ["email", "mail:", "contact", "write", "Email:"], ["card", "visa", "Visa:", "credit", "mastercard", "debit"], ["token", "secret", "key", "api_key", "apikey", "access_token", "client_secret", "API", "auth_token", "TOKEN", "Bearer"], ["SSN", "ssn:", "passport", "IBAN", "iban:", "account", "DNI", "Passport"]))
    sign = lambda: r.choice(["=", ":", "is", "=", "="])
    number = lambda: r.choice(["no", "number", "no.", "is", "nr"])
    # a tuple stands for a labelled word
    positive = [
        ("phone", phrase(tel, P(lambda: f"{d(3)}-{d(3)}-{d(4)}"))),
        ("phone", phrase(P(lambda: f"({d(3)})"), P(lambda: f"{d(3)}-{d(4)}"))),
        ("phone", phrase(tel, P(lambda: f"({d(3)})"), P(lambda: f"{d(3)}-{d(4)}"))),
        ("phone", phrase(tel, P(lambda: d(3)), P(lambda: d(3)), P(lambda: d(4)))),
        ("phone", phrase(tel, P(lambda: f"{d(3)}.{d(3)}.{d(4)}"))),
        ("phone", phrase(P(lambda: f"{d(3)}-{d(3)}-{d(4)}"))),
        ("phone", phrase(tel, P(lambda: f"0{d(1)}"), P(lambda: d(2)), P(lambda: d(2)), P(lambda: d(2)), P(lambda: d(2)))),
        ("phone", phrase(P(lambda: f"0{r.choice('1234567')}"), P(lambda: d(2)), P(lambda: d(2)), P(lambda: d(2)), P(lambda: d(2)))),
        ("phone", phrase(tel, P(lambda: f"0{d(3)}"), P(lambda: d(r.randint(6, 7))))),
        ("email", phrase(mail, P(name), P(lambda: r.choice(["[at]", "(at)", "at", "{at}"])), P(lambda: f"{name()}.com"))),
        ("email", phrase(P(name), P(lambda: r.choice(["[at]", "(at)"])), P(lambda: f"{name()}.{r.choice(['com', 'org', 'de'])}"))),
        ("email", phrase(P(name), P(lambda: r.choice(["[at]", "(at)", "at"])), P(name), P(lambda: r.choice(["[dot]", "(dot)", "dot"])), P(lambda: r.choice(["com", "org", "net"])))),
        ("card", phrase(pay, P(lambda: d(4)), P(lambda: d(4)), P(lambda: d(4)), P(lambda: d(4)))),
        ("card", phrase(pay, number, P(lambda: "-".join(d(4) for _ in range(4))))),
        ("card", phrase(pay, P(lambda: d(16)))),
        ("secret", phrase(sec, sign, P(lambda: quoted(key())))),
        ("secret", phrase(sec, P(lambda: quoted(key())))),
        ("secret", phrase(lambda: f"{sec()}:", P(lambda: quoted(key())))),
        ("secret", phrase(P(lambda: f"{sec()}{r.choice(['=', ':'])}{quoted(key())}"))),
        ("secret", phrase(lambda: r.choice(["password", "Password:", "pwd", "passwd", "passwort", "password:"]), sign, P(lambda: quoted(password())))),
        ("secret", phrase(lambda: r.choice(["password:", "Password:", "pwd:", "passwd="]), P(lambda: quoted(password())))),
        ("secret", phrase(P(lambda: f"{r.choice(['password', 'pwd', 'passwd'])}={password()}"))),
        ("id", phrase(lambda: r.choice(["SSN", "ssn:", "SSN:"]), P(lambda: f"{d(3)}-{d(2)}-{d(4)}"))),
        ("id", phrase("social", "security", number, P(lambda: f"{d(3)}-{d(2)}-{d(4)}"))),
        ("id", phrase(P(lambda: f"{d(3)}-{d(2)}-{d(4)}"))),
        ("id", phrase(lambda: r.choice(["passport", "Passport", "passport:", "Reisepass"]), number, P(lambda: some(upper, r.randint(1, 2)) + d(7)))),
        ("id", phrase(lambda: r.choice(["passport", "passport:", "DNI", "licence"]), P(lambda: r.choice([some(upper, 1) + d(8), d(8) + some(upper, 1), d(9)])))),
        ("id", phrase(lambda: r.choice(["IBAN", "iban:", "IBAN:", "account"]), P(lambda: some(upper, 2) + d(20)))),
        ("id", phrase(lambda: r.choice(["IBAN", "IBAN:"]), P(lambda: some(upper, 2) + d(2)), P(lambda: d(4)), P(lambda: d(4)), P(lambda: d(4)), P(lambda: d(4)), P(lambda: d(2)))),
    ]
    negative = [
        lambda: [d(r.randint(1, 5))], lambda: [d(16)], lambda: [d(r.randint(8, 20))], lambda: [f"{d(4)}-{d(2)}-{d(2)}"], lambda: [f"{d(2)}.{d(2)}.{d(4)}"], lambda: [f"{d(2)}/{d(2)}/{d(4)}"],
        lambda: [r.choice(["version", "v", "build", "release"]), f"{d(1)}.{d(2)}.{d(1)}"], lambda: [f"{d(1)}.{d(1)}"], lambda: [f"v{d(1)}.{d(2)}"], lambda: [f"${d(2)},{d(3)}.{d(2)}"], lambda: [f"{d(2)}%"],
        lambda: [r.choice(["commit", "sha1", "md5:", "checksum", "hash", "sha256:", "etag"]), some("0123456789abcdef", r.choice([32, 40, 64]))], lambda: [some("0123456789abcdef", r.choice([32, 40, 64]))], lambda: ["uuid", "-".join(some("0123456789abcdef", k) for k in (8, 4, 4, 4, 12))],
        lambda: [f"{d(4)}-{d(4)}"], lambda: ["year", d(4)], lambda: [d(3), d(3)], lambda: [d(4), d(4)], lambda: [d(4), d(4), d(4), d(4)], lambda: [d(2), d(2), d(2)], lambda: [f"@{name()}"], lambda: [f"{name()}@{name()}"], lambda: [r.choice(["page", "chapter", "room", "item"]), d(3)],
        lambda: [f"{d(16)}", f"{d(16)}"], lambda: [f"{name()}{d(2)}"], lambda: ["order", r.choice(["no", "number", ""]), f"{d(3)}-{d(7)}-{d(7)}"], lambda: ["isbn", f"{d(3)}-{d(1)}-{d(4)}-{d(4)}-{d(1)}"], lambda: ["from", f"{d(2)}:{d(2)}", "to", f"{d(2)}:{d(2)}"],
        lambda: ["invoice", "no", some(upper, 2) + d(7)], lambda: ["part", some(upper, 1) + d(8)], lambda: ["the", "key", "is", name()], lambda: ["key", d(2)], lambda: ["token", d(1)], lambda: ["at", d(2)], lambda: ["dot", "com"], lambda: ["the", "password", "of", name()], lambda: ["password", "policy", d(2)],
        lambda: ["call", d(2), name()], lambda: ["call", "at", d(1)], lambda: ["card", d(2)], lambda: ["account", "of", d(4)], lambda: ["x", "=", d(2)], lambda: [f"a={d(3)}"], lambda: [name(), "at", f"{d(2)}:{d(2)}"], lambda: ["phone", "model", d(3)], lambda: ["name", "=", f'"{name()}"'],
    ]
    out = []
    for k in range(rows):
        before, after = plain(r.choice([0, 1, 2, 3, 4, 5])), plain(r.choice([0, 1, 2, 3, 4]))
        middle, labels = [], []
        if k % 2:
            kind, make = positive[k // 2 % len(positive)]
            for w in make():
                if isinstance(w, tuple):
                    labels.append("I-" + kind if labels and labels[-1] != "O" else "B-" + kind)
                    middle.append(w[1])
                else:
                    labels.append("O")
                    middle.append(w)
            middle[-1] += r.choice(["", "", ".", ",", "!!", "###"])
        else:
            middle = [w for w in negative[k // 2 % len(negative)]() if w]
            middle[-1] += r.choice(["", "", ".", ","])
            labels = ["O"] * len(middle)
        out.append((before + middle + after, ["O"] * len(before) + labels + ["O"] * len(after)))
    # prose without digits: an "at" that makes no address, words said again and again, letters outside of ASCII
    at = lambda: r.choice(["at", "at", "at", "At", "at,"])
    foreign = lambda: r.choice([str, str.title, str.upper])("".join(r.choices("éèáóöüñßç" + letters, k=r.randint(1, 7)))) + mark()
    prose = [
        lambda: [*plain(r.randint(1, 4)), at(), *plain(r.randint(1, 4))],
        lambda: [w for _ in range(r.randint(2, 4)) for w in (*plain(r.choice([0, 1, 1, 2, 3])), at())] + plain(r.randint(1, 4)),
        lambda: [*plain(1) * r.randint(1, 4), *[r.choice(["at", "At"])] * r.randint(3, 12), *plain(1) * r.randint(1, 4)],
        lambda: [*["".join(r.choices(syllables, k=r.randint(1, 2)))] * r.randint(1, 4), *["at"] * r.randint(3, 12), *["".join(r.choices(syllables, k=2))] * r.randint(1, 4)],
        lambda: [*plain(r.randint(0, 2)), *[foreign()] * r.randint(3, 12), *plain(r.randint(0, 2))],
        lambda: [foreign() for _ in range(r.randint(3, 12))],
    ]
    for k in range(rows // 12):
        words = prose[k % len(prose)]()
        out.append((words, ["O"] * len(words)))
    # a written-out address need not follow its cue word at once
    for _ in range(rows // 80):
        before, after = [*plain(r.randint(0, 3)), mail(), *plain(1)], plain(r.randint(0, 3))
        middle = [name(), r.choice(["[at]", "(at)", "at"]), *r.choice([[f"{name()}.com"], [name(), r.choice(["[dot]", "(dot)", "dot"]), r.choice(["com", "org", "net"])]])]
        out.append((before + middle + after, ["O"] * len(before) + ["B-email"] + ["I-email"] * (len(middle) - 1) + ["O"] * len(after)))
    return out


def train(rows: list[tuple[list[str], list[str]]], rounds: int = 80, rate: float = 0.5, penalty: float = 2e-3) -> RandomField:
    """Gradient ascent (AdaGrad) on the likelihood; forward and backward sums for all sequences at once."""
    names: dict[str, int] = {}
    ids = [[[names.setdefault(f, len(names)) for f in features(w, i)] for i in range(len(w))] for w, _ in rows]
    crf = RandomField(names)
    n, size, k = len(rows), max(len(w) for w, _ in rows), len(LABELS)
    width = len(ids[0][0])
    x = np.full((n, size, width), len(names))
    gold, on = np.zeros((n, size), np.int64), np.zeros((n, size), bool)
    for i, (own, (_, labels)) in enumerate(zip(ids, rows, strict=True)):
        x[i, : len(own)], gold[i, : len(own)], on[i, : len(own)] = own, [LABELS.index(y) for y in labels], True
    target = np.eye(k)[gold] * on[..., None]
    pairs = np.einsum("nta,ntb->ab", target[:, :-1], target[:, 1:])
    seen_e, seen_p = np.full(crf.emit.shape, 1e-6), np.full(crf.pair.shape, 1e-6)
    lse = lambda a, axis: (m := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis=axis))
    for _ in range(rounds):
        e = crf.emit[x].sum(axis=2)
        move = crf.pair + crf.barred
        fwd, bwd = np.zeros((n, size, k)), np.zeros((n, size, k))
        fwd[:, 0] = e[:, 0] + crf.first
        for t in range(1, size):
            fwd[:, t] = np.where(on[:, t, None], lse(fwd[:, t - 1][:, :, None] + move, 1) + e[:, t], fwd[:, t - 1])
        for t in range(size - 2, -1, -1):
            bwd[:, t] = np.where(on[:, t + 1, None], lse(move + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], 2), 0.0)
        z = lse(fwd[:, -1], 1)
        prob = np.exp(fwd + bwd - z[:, None, None]) * on[..., None]
        both = np.exp(fwd[:, :-1, :, None] + move + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None]) * on[:, 1:, None, None]
        grad_e = np.zeros_like(crf.emit)
        for c in range(width):
            np.add.at(grad_e, x[..., c], target - prob)
        grad_e = grad_e / n - penalty * crf.emit
        grad_e[-1] = 0
        grad_p = (pairs - both.sum(axis=(0, 1))) / n - penalty * crf.pair
        seen_e += grad_e**2
        seen_p += grad_p**2
        crf.emit += rate * grad_e / np.sqrt(seen_e)
        crf.pair += rate * grad_p / np.sqrt(seen_p)
    del e, fwd, bwd, prob, both, x, target
    give_back()
    return crf


def all_words(text: str) -> list[tuple[list[str], list[tuple[int, int]], np.ndarray]]:
    """Words, their places, and which of them may be labelled: every one, in one stretch."""
    places = [m.span() for m in _WORD.finditer(text)]
    return [([text[a:b] for a, b in places], places, np.ones(len(places), bool))] if places else []


stretches = all_words


def added_spans(crf: RandomField, texts: list[str], base: list[list[Span]], whole: bool = False, contexts: Contexts | None = None) -> list[list[Span]]:
    """Spans of the random field that overlap none of the patterns; ``whole`` scores and decodes word by word (for tests)."""
    if whole:
        found = [(i, w) for i, t in enumerate(texts) for w, _, _ in all_words(t)]
        labels = dict(zip((i for i, _ in found), crf.viterbi([crf.scores(w) for _, w in found]), strict=True))
    else:
        labels = (contexts or Contexts(crf)).labels(texts)
    out: list[list[Span]] = [[] for _ in texts]
    for i, y in labels.items():
        if not y.any():
            continue
        [(_, places, _)] = stretches(texts[i])
        k = 0
        while k < len(y):
            label = LABELS[y[k]]
            if label[0] != "B":
                k += 1
                continue
            stop = k + 1
            while stop < len(y) and LABELS[y[stop]] == "I-" + label[2:]:
                stop += 1
            start, end = trimmed(texts[i], label[2:], places[k][0], places[stop - 1][1])
            if end > start and not any(a < end and start < b for a, _, b in base[i]):
                out[i].append((start, label[2:], end))
            k = stop
    for spans in out:
        spans.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    return out


def trimmed(text: str, kind: str, start: int, end: int) -> tuple[int, int]:
    """A span without marks around it; a secret without the name that it is given to."""
    if kind == "secret" and (m := _NAMED.match(text[start:end])):
        start += m.end()
    keep = "(" if kind in ("phone", "email") else ""
    while end > start and not text[end - 1].isalnum() and not (kind == "secret" and text[end - 1] in "=" and text[start:end].rstrip("=").isalnum()):
        end -= 1
    while start < end and not text[start].isalnum() and text[start] not in keep:
        start += 1
    return start, end


def find(docs: DataFrame, crf: RandomField | None = None) -> DataFrame:
    """(doc_id, counts and spans of the patterns, spans added by the random field); one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(crf or train(training_table()))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts = Contexts(shared.value)
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                base = [base_spans(t) for t in texts]
                added = added_spans(shared.value, texts, base, contexts=contexts)
                rows = lambda spans: pa.array([[{"kind": k, "start": a, "end": b} for a, k, b in s] for s in spans], span)
                counts = [pa.array([sum(k == kind for _, k, _ in s) for s in base], pa.int64()) for kind in BASE_KINDS]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *counts, rows(base), rows(added)], ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base", "added"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda b: released(run(b)), SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    rank = lambda k: F.array_position(F.array(*map(F.lit, KINDS)), k)
    every = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.select("doc_id", *(f"n_{k}" for k in BASE_KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"), (F.size("base") + F.size("added")).cast("long").alias("n_spans"), F.size("added").cast("long").alias("n_added"))


def redact(docs: DataFrame, crf: RandomField | None = None) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by ``<kind>``; overlapping spans become one, of the first's kind."""
    shared = docs.sparkSession.sparkContext.broadcast(crf or train(training_table()))
    schema = docs.schema

    def masked(text: str, spans: list[Span]) -> str:
        out, at = [], 0
        for start, kind, end in sorted(spans):
            if start >= at:
                out += [text[at:start], f"<{kind}>"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts = Contexts(shared.value)
        for batch in batches:
            for part in chunks(batch, "text"):
                raw = part.column("text").to_pylist()
                texts = [t or "" for t in raw]
                base = [base_spans(t) for t in texts]
                added = added_spans(shared.value, texts, base, contexts=contexts)
                out = [t if t is None else masked(t, b + a) if a or b else t for t, b, a in zip(raw, base, added, strict=True)]
                yield part.set_column(part.schema.get_field_index("text"), "text", pa.array(out, pa.string()))

    return docs.mapInArrow(lambda b: released(run(b)), schema)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find(table(spark, sf_dir, "documents")))
