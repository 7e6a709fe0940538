"""HTML extraction by union-free regular-expression inference.

A page is read as a tree of block elements and text slots. Neighbours of one kind fold into repeated parts ``(...)+``, and
so do sequences that repeat (``(h2 p)+``). What is left is the page's shape: the shapes of a host's pages are aligned with
each other, level by level; parts that match become one, parts that one side lacks become optional ``(...)?``, texts become slots.
What comes out is the host's wrapper: a regular expression without unions. Every slot carries what its texts were like: on how
many pages it stands, whether they were all equal, how many characters were links.

The wrapper decides what is content (``judged``). A slot whose text is the same on the host's differing pages is template, but for headings, paragraphs and
the like inside the element that holds the articles. A slot that repeats and holds links only is a menu. The element that holds the articles is found by where the varying text stands: an
``article`` or ``main`` element, else the container of most varying text. Names of elements, classes and roles
are looked at only beside and inside it, never on the elements around it, and an element that holds a third of it goes only if it
is named as comments, adverts or the like. To extract a page, its shape is aligned with its host's wrapper, and the texts of content slots are
taken in page order; a part that the wrapper lacks is judged by names alone.

Shapes without texts are few, so pages are counted by shape before any alignment. A host's shapes are aligned in
groups of about ``FAN_IN``, the groups' wrappers again, and so on; no task sees all of a host. A wrapper of over ``WRAPPER_PARTS``
parts is written again without the class names that mean nothing, so that its parts fold. Wrappers are joined to pages by
a broadcast if they have ``BROADCAST_CHARS`` characters at most; beyond, by a shuffle in which Spark splits a hot host.

Defined results: null html counts as empty; a page without content has an empty text; pages with a null url are one host, as are those
whose url has none; comments and raw elements that never end reach to the page's end; repeated rows get equal results; ``br`` is white space
inside a block, ``hr`` ends one; a page with an article or main element has content only inside such elements; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, cut, discard, released, table

FAN_IN = 32
FOLD = 12  # longest repeated sequence, in parts
WRAPPER_PARTS = 3000
DEPTH = 100  # of a tree
BROADCAST_CHARS = 16_000_000  # of all wrappers
HELD_SHAPES = 2000  # of a task, before they are passed on
SURE_PAGES = 3  # pages on which a text must be the same to be template
LARGE = 1 / 3  # share of the text from which an element goes by strong names only

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg math object canvas audio video select option head".split()) - {"head"}
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: An opening tag ends an open element of its kind, unless one of the holders stands between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Names that hold no article text: fixed values. Strong ones hold for any size.
AROUND_TAGS = frozenset("nav footer aside form button dialog menu fieldset".split())
STRONG_WORDS = frozenset("hidden comment comments disqus replies cookie cookies consent gdpr ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors newsletter".split())
AROUND_WORDS = STRONG_WORDS | frozenset(
    "nav navbar navigation menu footer contentinfo sidebar sidebars complementary widget widgets promo promos promotion promoted notice notices notification alert popup modal overlay subscribe subscription signup signin login breadcrumb breadcrumbs pagination pager share sharing social related recommended recommendations reply respond form search searchbox toolbar skip copyright legal".split()
)
HEADER_WORDS = frozenset("header banner topbar masthead".split())
#: Words that may follow such a word in one name: ``cookie-banner`` is about cookies, ``legal-guide`` isn't around the article.
HOLDERS = frozenset(
    "area bar block body box boxes btn button buttons col column container content footer form group head header holder icons inner input item items left link links list main panel posts region right row section set site slot strip text title top unit widget wrap wrapper zone banner message popup modal overlay notice bottom outer area thread container box".split()
)
MAIN = frozenset(("article", "main"))
#: Kinds that fold whatever they hold; inside an article, text that is equal everywhere is template only outside of them.
PLAIN = frozenset("p li dt dd tr td th h1 h2 h3 h4 h5 h6 figcaption caption blockquote pre option address summary".split())

_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>")
_ATTR = re.compile(r"([A-Za-z-]+)\s*+(?:=\s*+(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")


def label(tag: str, attributes: str) -> str:
    """Element name with its class, id and role names, digits left out, words joined by ``-``; ``hidden`` where it isn't shown."""
    if "=" not in attributes and "hidden" not in attributes:
        return tag
    names: list[str] = []
    for m in _ATTR.finditer(attributes):
        k, v = m.group(1).lower(), (m.group(2) or "").strip("\"'")
        if k in ("class", "id", "role"):
            names += ["-".join(w.lower() for w in _WORDS.findall(x)) for x in v.split()]
        elif k == "hidden" or k == "style" and re.search(r"display\s*:\s*none", v, re.I) or k == "aria-hidden" and v.lower() == "true":
            names.append("hidden")
    return ".".join([tag, *(n for n in dict.fromkeys(names) if n)])


def tag_of(said: str) -> str:
    return said.partition(".")[0]


def named(said: str, words: frozenset[str]) -> bool:
    """Whether one of an element's names is about one of the words: its last word, or its first before a holder's."""
    for name in said.split(".")[1:]:
        parts = name.split("-")
        if parts[-1] in words or any(w in words and parts[k + 1] in HOLDERS for k, w in enumerate(parts[:-1])):
            return True
    return False


Part = list  # [label or "#" or "()", kids or what a slot carries, repeated, optional]


class Page:
    """Texts of a page, in order, and its folded tree; a slot carries the numbers of its texts."""

    def __init__(self, source: str):
        self.texts: list[str] = []
        self.linked: list[bool] = []  # links only
        self.stack: list[tuple[str, str, list[Part]]] = [("", "", [])]  # (tag, label, kids)
        self.text: list[str] = []
        self.links, self.free = 0, False
        self.read(source)
        self.tree = fold(self.stack[0][2])

    def flush(self) -> None:
        said = _SPACE.sub(" ", entities.unescape("".join(self.text))).strip(" ")
        self.text = []
        if said:
            self.stack[-1][2].append(["#", [len(self.texts)], False, False])
            self.texts.append(said)
            self.linked.append(not self.free)
        self.free = False

    def pop(self, k: int) -> None:
        while len(self.stack) > k:
            _, said, kids = self.stack.pop()
            if kids is not self.stack[-1][2]:
                self.stack[-1][2].append([said, fold(kids), False, False])

    def close(self, kinds: set[str] | frozenset[str], holders: set[str] | frozenset[str]) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in kinds:
                self.pop(k)
                return
            if self.stack[k][0] in holders:
                return

    def tag(self, end: bool, name: str, attributes: str) -> None:
        if name in INLINE:
            if name == "a":
                self.links = max(0, self.links + (-1 if end else 1))
            return
        if name == "br":
            self.text.append(" ")
            return
        self.flush()
        if name in VOID:
            return
        if end:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k][0] == name:
                    self.pop(k)
                    break
            return
        if name in CLOSES_P:
            self.close({"p"}, {"td", "th", "li", "div", "section", "article", "body"})
        if name in ENDS:
            self.close(*ENDS[name])
        self.links = 0
        # deeper elements lend their texts to the last one
        self.stack.append((name, label(name, attributes), [] if len(self.stack) < DEPTH else self.stack[-1][2]))

    def read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            lt = source.find("<", at)
            if lt < 0:
                lt = size
            if lt > at:
                piece = source[at:lt]
                self.text.append(piece)
                if not self.links and not self.free and not piece.isspace():
                    self.free = True
            if lt == size:
                break
            if source.startswith("<!--", lt):
                end = source.find("-->", lt + 4)
                at = size if end < 0 else end + 3
                continue
            after = source[lt + 1 : lt + 2]
            if after in ("!", "?"):
                end = source.find(">", lt)
                at = size if end < 0 else end + 1
                continue
            if not (after.isalpha() and after.isascii() or after == "/" and source[lt + 2 : lt + 3].isalpha()):
                self.text.append("<")
                self.free = self.free or not self.links
                at = lt + 1
                continue
            m = _TAG.match(source, lt)
            if m:
                end, name, attributes, at = m.group(1) == "/", m.group(2).lower(), m.group(3), m.end()
            else:  # a quote without its end
                stop = source.find(">", lt)
                if stop < 0:
                    break
                m = re.match(r"</?([A-Za-z][A-Za-z0-9:-]*)", source[lt:stop])
                end, name, attributes, at = after == "/", m.group(1).lower(), "", stop + 1
            if name in RAW and not end:
                self.flush()
                if not attributes.rstrip().endswith("/"):
                    stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, at)
                    at = stop.end() if stop else size
                continue
            self.tag(end, name, attributes)
        self.flush()
        self.pop(1)


# --- inference ---


def kind(part: Part) -> str | tuple:
    """What neighbours must share to fold: containers also the kinds of what they hold."""
    if part[0] == "#" or tag_of(part[0]) in PLAIN:
        return part[0]
    return (part[0], *(x[0] for x in part[1]))


def both_lists(a: list, b: list) -> list:
    return a + b


def merge(a: Part, b: Part, join: Callable) -> Part:
    """One part for two of the same label."""
    return [a[0], join(a[1], b[1]) if a[0] == "#" else align(a[1], b[1], join), a[2] or b[2], a[3] or b[3]]


def fold(parts: list[Part]) -> list[Part]:
    """Neighbours of one kind, and then sequences that repeat, as one repeated part, the shortest first."""
    for width in range(1, FOLD + 1):
        kinds = [kind(p) for p in parts] if width == 1 else [p[0] if p[0] != "()" else kind(p) for p in parts]
        if len(parts) < 2 * width or len(set(kinds)) == len(kinds):
            break
        out: list[Part] = []
        k = 0
        while k < len(parts):
            n = k + width
            while n + width <= len(parts) and kinds[n : n + width] == kinds[k : k + width]:
                n += width
            if n > k + width:
                whole = [list(p) for p in parts[k : k + width]]
                for m in range(k + width, n, width):
                    whole = [merge(p, q, both_lists) for p, q in zip(whole, parts[m : m + width], strict=True)]
                if width == 1:
                    whole[0][2] = True
                    out += whole
                else:
                    out.append(["()", whole, True, False])
                k = n
            else:
                out.append(parts[k])
                k += 1
        parts = out
    return parts


def grouped(parts: list[Part], groups: list[Part], join: Callable) -> list[Part]:
    """Occurrences of another side's groups, written as the group."""
    for g in groups:
        inside = [x[0] for x in g[1]]
        width, out, k = len(inside), [], 0
        while k < len(parts):
            if [x[0] for x in parts[k : k + width]] == inside:
                if out and out[-1][0] == "()" and [x[0] for x in out[-1][1]] == inside:
                    out[-1] = ["()", [merge(p, q, join) for p, q in zip(out[-1][1], parts[k : k + width], strict=True)], True, out[-1][3]]
                else:
                    out.append(["()", parts[k : k + width], True, False])
                k += width
            else:
                out.append(parts[k])
                k += 1
        parts = out
    return parts


def label_key(part: Part) -> str | tuple:
    return part[0] if part[0] != "()" else ("()", *(x[0] for x in part[1]))


def align(a: list[Part], b: list[Part], join: Callable) -> list[Part]:
    """One list of parts for two: what matches is merged, what one side lacks becomes optional."""
    keys, other = [label_key(p) for p in a], [label_key(p) for p in b]
    if keys != other:
        a, b = grouped(a, [p for p in b if p[0] == "()"], join), grouped(b, [p for p in a if p[0] == "()"], join)
        keys, other = [label_key(p) for p in a], [label_key(p) for p in b]
    if keys == other:
        return [merge(p, q, join) if p[0] != "()" else ["()", align(p[1], q[1], join), True, p[3] or q[3]] for p, q in zip(a, b, strict=True)]
    out: list[Part] = []
    # parts alike in what they hold first, and between those, parts of the same label
    pairs: list[tuple[int, int]] = []
    rich, poor = [kind(p) for p in a], [kind(p) for p in b]
    i = j = 0
    for x, y, n in SequenceMatcher(None, rich, poor, autojunk=False).get_matching_blocks():
        for u, v, m in SequenceMatcher(None, keys[i:x], other[j:y], autojunk=False).get_matching_blocks():
            pairs += [(i + u + k, j + v + k) for k in range(m)]
        pairs += [(x + k, y + k) for k in range(n)]
        i, j = x + n, y + n
    i = j = 0
    for x, y in [*pairs, (len(a), len(b))]:
        out += [[*p[:3], True] for p in a[i:x]] + [[*p[:3], True] for p in b[j:y]]
        if x < len(a):
            out.append(merge(a[x], b[y], join) if a[x][0] != "()" else ["()", align(a[x][1], b[y][1], join), True, a[x][3] or b[y][3]])
        i, j = x + 1, y + 1
    return out


def slots(parts: list[Part], path: tuple = ()) -> Iterator[tuple[tuple, Part]]:
    """(path of elements and groups, slot) of every slot, in order."""
    for p in parts:
        if p[0] == "#":
            yield path, p
        else:
            yield from slots(p[1], (*path, p))


def written(parts: list[Part]) -> str:
    """The wrapper as one expression."""
    out = []
    for p in parts:
        inside = "#" if p[0] == "#" else written(p[1]) if p[0] == "()" else f"<{p[0]}> {written(p[1])} </{tag_of(p[0])}>".replace(">  <", "> <")
        out.append(f"({inside})+" if p[2] else inside)
        if p[3]:
            out[-1] = f"({out[-1]})?"
    return " ".join(out)


def filled(parts: list[Part], values: Iterator) -> list[Part]:
    """A copy whose slots carry the values, in order."""
    return [[p[0], next(values) if p[0] == "#" else filled(p[1], values), p[2], p[3]] for p in parts]


def seen_together(a: list, b: list) -> list:
    """What two slots' texts were like, in one: pages, least and greatest page, least and greatest text, characters, those in links."""
    return [a[0] + b[0], min(a[1], b[1]), max(a[2], b[2]), min(a[3], b[3]), max(a[4], b[4]), a[5] + b[5], a[6] + b[6]]


def coarse(parts: list[Part], join: Callable) -> list[Part]:
    """Without names that mean nothing; parts that become alike fold, of all widths."""
    out: list[Part] = []
    for p in parts:
        if p[0] == "#":
            q = p
        elif p[0] == "()":
            q = ["()", coarse(p[1], join), p[2], p[3]]
        else:
            tag, *names = p[0].split(".")
            q = [".".join([tag, *(n for n in names if named(f"x.{n}", AROUND_WORDS | HEADER_WORDS))]), coarse(p[1], join), p[2], p[3]]
        if out and q[0] != "()" and out[-1][0] == q[0]:
            out[-1] = merge(out[-1], q, join)
            out[-1][2] = True
        else:
            out.append(q)
    return out


def parts_in(parts: list[Part]) -> int:
    return sum(1 + (parts_in(p[1]) if p[0] != "#" else 0) for p in parts)


def one_wrapper(trees: list[dict], limit: int) -> dict:
    """The wrapper of several, each {"parts": ..., "coarse": ...}; slots carry what their texts were like."""
    rough = any(t["coarse"] for t in trees)
    whole: list[Part] | None = None
    for t in trees:
        own = coarse(t["parts"], seen_together) if rough and not t["coarse"] else t["parts"]
        whole = own if whole is None else align(whole, own, seen_together)
        if not rough and parts_in(whole) > limit:
            rough, whole = True, coarse(whole, seen_together)
    return {"parts": whole, "coarse": rough}


# --- judgement ---


NOT, ELSE, CONTENT = 0, 1, 2


def judged(parts: list[Part]) -> list[int]:
    """``CONTENT``, ``ELSE`` (content of pages that have none in a main element) or ``NOT`` for each slot of a wrapper, in order.

    Slots carry what :func:`seen_together` gives.
    """
    own = list(slots(parts))
    fixed = [s[1][0] >= SURE_PAGES and s[1][3] == s[1][4] and s[1][1] != s[1][2] for _, s in own]
    mass: dict[int, int] = {}  # varying characters outside of links, by element
    for (path, s), f in zip(own, fixed, strict=True):
        for p in path:
            mass[id(p)] = mass.get(id(p), 0) + (0 if f else s[1][5] - s[1][6])
    total = max(1, sum(0 if f else s[1][5] - s[1][6] for (_, s), f in zip(own, fixed, strict=True)))

    def weak(p: Part) -> bool:
        return p[0] != "()" and (tag_of(p[0]) in AROUND_TAGS or named(p[0], AROUND_WORDS))

    def strong(p: Part) -> bool:
        return p[0] != "()" and named(p[0], STRONG_WORDS)

    def header(p: Part) -> bool:
        return p[0] != "()" and tag_of(p[0]) not in ("html", "body") and (tag_of(p[0]) == "header" or named(p[0], HEADER_WORDS))

    # the article: the main element of most varying text that stands in nothing strongly named; else most text's container
    heart: tuple = ()
    best = -1
    for path, _ in own:
        for k, p in enumerate(path):
            if tag_of(p[0]) in MAIN and mass[id(p)] > best and not any(strong(q) for q in path[: k + 1]) and not any(weak(q) and mass[id(q)] < 0.8 * total for q in path[:k]):
                heart, best = path[: k + 1], mass[id(p)]
    within = bool(heart)
    while not within:
        inside = {id(q): (path, k) for path, _ in own for k, q in enumerate(path) if k == len(heart) and path[:k] == heart}
        deeper = [(path, k) for q, (path, k) in inside.items() if tag_of(path[k][0]) not in PLAIN and mass[q] >= 0.8 * total and not strong(path[k])]
        if not deeper:
            break
        path, k = deeper[0]
        heart = path[: k + 1]
    around = {id(p) for p in heart}
    core = [id(p) for p in heart] if heart and tag_of(heart[-1][0]) not in ("html", "body") else None
    scale = max(1, mass[id(heart[-1])] if heart else total)
    out = []
    for (path, s), f in zip(own, fixed, strict=True):
        _, _, _, _, _, chars, links = s[1]
        in_main = any(tag_of(p[0]) in MAIN for p in path)
        ok, seen_main = True, False
        for p in path:
            large = mass[id(p)] >= LARGE * scale
            if id(p) not in around and (strong(p) or weak(p) and not large or header(p) and not seen_main and not large):
                ok = False
            seen_main = seen_main or tag_of(p[0]) in MAIN
        menu = links >= 0.9 * chars and (s[2] or any(p[2] for p in path))
        if menu and not in_main:
            ok = False
        held = in_main or [id(p) for p in path[: len(heart)]] == core
        if f and not (held and path and tag_of(path[-1][0]) in PLAIN):
            ok = False
        out.append(CONTENT if ok and in_main else ELSE if ok else NOT)
    return out


def page_slots(page: Page) -> list[list]:
    """What a page's slots are like, each as :func:`seen_together` has it."""
    whole = hash_of("\n".join(page.texts))
    out = []
    for _, s in slots(page.tree):
        said = "\n".join(page.texts[k] for k in s[1])
        h = hash_of(said)
        out.append([1, whole, whole, h, h, sum(len(page.texts[k]) for k in s[1]), sum(len(page.texts[k]) for k in s[1] if page.linked[k])])
    return out


def hash_of(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) | len(text) % 2**20 << 32


def infer(pages: DataFrame, fan_in: int = FAN_IN, limit: int = WRAPPER_PARTS) -> DataFrame:
    """(host, wrapper): a wrapper for each host of pages (host, html), as JSON; hosts without any text have none."""
    lists = "pages long, least array<long>, most array<long>, low array<long>, high array<long>, chars array<long>, links array<long>"

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], np.ndarray] = {}

        def out() -> pa.RecordBatch:
            at = list(held.values())
            columns = [pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.string()), pa.array([int(x[0, 0]) for x in at], pa.int64())]
            columns += [pa.array([x[:, c].tolist() for x in at], pa.list_(pa.int64())) for c in range(1, 7)]
            return pa.RecordBatch.from_arrays(columns, ["host", "shape", "pages", "least", "most", "low", "high", "chars", "links"])

        for batch in batches:
            for part in chunks(batch, "html"):
                for host, source in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    page = Page(source or "")
                    if not page.texts:
                        continue
                    key, own = (host, shape_of(page.tree)), np.array(page_slots(page), np.int64)
                    if key in held:
                        was = held[key]
                        own = np.stack([was[:, 0] + own[:, 0], np.minimum(was[:, 1], own[:, 1]), np.maximum(was[:, 2], own[:, 2]), np.minimum(was[:, 3], own[:, 3]), np.maximum(was[:, 4], own[:, 4]), was[:, 5] + own[:, 5], was[:, 6] + own[:, 6]], axis=1)
                    held[key] = own
            if len(held) > HELD_SHAPES:
                yield out()
                held = {}
        if held:
            yield out()

    seen = pages.select("host", "html").mapInArrow(shapes, f"host string, shape string, {lists}")
    each = seen.select("host", "shape", "pages", F.posexplode(F.arrays_zip("least", "most", "low", "high", "chars", "links")).alias("at", "s"))
    each = each.groupBy("host", "shape", "at").agg(F.sum("pages").alias("p"), F.min("s.least").alias("a"), F.max("s.most").alias("b"), F.min("s.low").alias("c"), F.max("s.high").alias("d"), F.sum("s.chars").alias("e"), F.sum("s.links").alias("f"))
    whole = each.groupBy("host", "shape").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("at", F.array("p", "a", "b", "c", "d", "e", "f").alias("v")))), lambda x: x["v"])).alias("seen"))

    def started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [json.dumps({"parts": filled(json.loads(a), iter(json.loads(b))), "coarse": False}) for a, b in zip(batch.column("shape").to_pylist(), batch.column("seen").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(trees, pa.string())], ["host", "wrapper"])

    def together(group: pa.Table) -> pa.Table:
        wrapper = one_wrapper([json.loads(w) for w in sorted(group.column("wrapper").to_pylist())], limit)
        return pa.table({"host": group.column("host")[:1], "wrapper": pa.array([json.dumps(wrapper)], pa.string())})

    form = "host string, wrapper string"
    wrappers = cut(whole.mapInArrow(started, form))
    while True:
        most = wrappers.groupBy("host").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return wrappers
        buckets = -(-most // fan_in)
        merged = cut(wrappers.groupBy("host", F.pmod(F.xxhash64("wrapper", F.lit(most)), F.lit(buckets)).alias("salt")).applyInArrow(lambda _, g: together(g), form))
        discard(wrappers)
        wrappers = merged


def shape_of(tree: list[Part]) -> str:
    """A folded tree without what its slots carry."""

    def bare(parts: list[Part]) -> list:
        return [["#", 0, p[2], p[3]] if p[0] == "#" else [p[0], bare(p[1]), p[2], p[3]] for p in parts]

    return json.dumps(bare(tree), separators=(",", ":"))


class Extractor:
    """One host's wrapper, for any number of pages."""

    def __init__(self, wrapper: str | None):
        got = json.loads(wrapper) if wrapper else {"parts": [], "coarse": False}
        self.coarse, self.parts = got["coarse"], got["parts"]
        self.content = judged(self.parts)
        self.known: dict[str, list[int | None]] = {}

    def roles(self, shape: str) -> list[int | None]:
        """The judgement of each slot of a shape, in order; None where the wrapper has no such slot."""
        if shape not in self.known:
            tree = json.loads(shape)
            out: list[int | None] = [None] * sum(1 for _ in slots(tree))
            wrapper = filled(self.parts, ([k] for k in range(len(self.content))))
            own = filled(tree, ([-1 - k] for k in range(len(out))))
            for _, s in slots(align(wrapper, coarse(own, both_lists) if self.coarse else own, both_lists)):
                if said := [self.content[k] for k in s[1] if k >= 0]:
                    for k in s[1]:
                        if k < 0:
                            out[-1 - k] = max(said)
            if len(self.known) > 1000:
                self.known.clear()
            self.known[shape] = out
        return self.known[shape]

    def text(self, page: Page) -> str:
        if not page.texts:
            return ""
        roles = self.roles(shape_of(page.tree))
        if None in roles:
            alone = judged(filled(page.tree, iter(page_slots(page))))
            roles = [b if a is None else a for a, b in zip(roles, alone, strict=True)]
        best = max(roles)
        kept = sorted(k for (_, s), role in zip(slots(page.tree), roles, strict=True) if role and role == best for k in s[1])
        return "\n".join(page.texts[k] for k in kept)


def extract(pages: DataFrame, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """(page_id, url, text) of every page, by its host's wrapper."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    wrappers = infer(own)
    size = wrappers.agg(F.sum(F.length("host") + F.length("wrapper"))).first()[0] or 0
    small = size <= broadcast_chars
    shared = pages.sparkSession.sparkContext.broadcast({r["host"]: r["wrapper"] for r in wrappers.collect()} if small else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Extractor] = {}
        for batch in batches:
            for part in chunks(batch, "html"):
                texts, hosts = [], part.column("host").to_pylist()
                for k, source in enumerate(part.column("html").to_pylist()):
                    if hosts[k] not in seen:
                        if len(seen) > 500:
                            seen.clear()
                        seen[hosts[k]] = Extractor(shared.value.get(hosts[k]) if small else part.column("wrapper")[k].as_py())
                    texts.append(seen[hosts[k]].text(Page(source)))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return (own if small else own.join(wrappers, "host", "left")).mapInArrow(lambda b: released(run(b)), "page_id long, url string, text string")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
