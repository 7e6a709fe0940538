"""Sections of HTML and XML documents, packages of word processors and archives as blocks with offsets; byte inspectors.

Files are read in Arrow batches, a file at a time. What a file may hold inflated is bounded by ``MAX_INFLATED`` and ``MAX_MEMBERS``; a file beyond that, an
encrypted, broken or unknown one has one row with an ``error_code`` and no text.
"""

from __future__ import annotations

import csv
import io
import re
import unicodedata
import zipfile
import zlib
from collections.abc import Callable, Iterator
from functools import reduce
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_INFLATED = 256 * 2**20
MAX_MEMBERS = 2000


def html_sections(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, n, kind, text): headings, paragraphs and list items in order, markup dropped; by JVM functions."""
    clean = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "")
    parts = F.regexp_extract_all(clean, F.lit(r"(?is)(<(?:h[1-6]|p|li)\b[^>]*>(?:(?!</?(?:h[1-6]|p|li|ul|ol|div|table|section|article|nav|footer|header|aside|body)\b).)*)"), F.lit(1))
    d = pages.select(key, F.posexplode(parts).alias("n", "part"))
    kind = F.lower(F.regexp_extract("part", r"^<([A-Za-z0-9]+)", 1))
    text = F.trim(F.regexp_replace(F.regexp_replace("part", r"<[^>]*>", ""), r"\s+", " "))
    return d.select(key, F.col("n").cast("long").alias("n"), kind.alias("kind"), text.alias("text"))


def parsed_xml(text: str) -> ElementTree.Element:
    """Without document types, as entities could blow a text up."""
    if re.search(r"<!(?:DOCTYPE|ENTITY)", text[:10_000], re.I):
        raise ElementTree.ParseError("document type")
    return ElementTree.fromstring(text)


def local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def xml_records(df: DataFrame, body: str, row: str, fields: list[str]) -> DataFrame:
    """(columns of df without body, n, fields..., error_code): one row for each ``row`` element at any depth, self-closing ones too; a field is its first child of that name.

    Text that is no XML has one row with the code INVALID_XML; XML without such elements, null and empty texts have none.
    """

    @F.pandas_udf(T.StructType([T.StructField("rows", T.ArrayType(T.MapType(T.StringType(), T.StringType()))), T.StructField("error", T.StringType())]))
    def found(values: pd.Series) -> pd.DataFrame:
        out = []
        for text in values:
            try:
                rows = []
                for e in parsed_xml(text).iter() if text and text.strip() else ():
                    if local(e.tag) == row:
                        own: dict[str, str] = {}
                        for c in e:
                            if local(c.tag) in fields:
                                own.setdefault(local(c.tag), "".join(c.itertext()))
                        rows.append(own)
                out.append((rows, None))
            except ElementTree.ParseError:
                out.append(([], "INVALID_XML"))
        return pd.DataFrame(out, columns=["rows", "error"])

    rest = [c for c in df.columns if c != body]
    d = df.select(*rest, found(F.col(body)).alias("_f")).select(*rest, F.col("_f.error").alias("error_code"), F.posexplode(F.when(F.col("_f.error").isNotNull(), F.array(F.lit(None).cast("map<string,string>"))).otherwise(F.col("_f.rows"))).alias("n", "_r"))
    return d.select(*rest, (F.col("n") + 1).alias("n"), *[F.try_element_at("_r", F.lit(f)).alias(f) for f in fields], "error_code")


def xml_sections(df: DataFrame, key: str, body: str) -> DataFrame:
    """(key, n, kind, name, text, error_code): sections of a parser's XHTML: pages (``div class="page"``), members of an archive (``package-entry``), else the whole body.

    White space is folded, empty sections are left out; text that is no XML has one row with INVALID_XML.
    """

    def sections(text: str | None) -> Iterator[tuple]:
        if not text or not text.strip():
            return
        root = parsed_xml(text)
        marked = [e for e in root.iter() if local(e.tag) == "div" and e.get("class") in ("page", "package-entry")]
        inner = {id(x) for e in marked for x in e.iter() if x is not e}
        parts = [e for e in marked if id(e) not in inner] or [e for e in root.iter() if local(e.tag) == "body"][:1]
        for e in parts:
            kind = {"page": "page", "package-entry": "archive_section"}.get(e.get("class"), "body")
            head = next((x for x in e.iter() if local(x.tag) == "h1"), None) if kind == "archive_section" else None
            said = " ".join("".join(e.itertext()).split())
            if said:
                yield kind, "".join(head.itertext()).strip() if head is not None else None, unicodedata.normalize("NFC", said)

    kind = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "name", "text", "error_code")]))

    @F.pandas_udf(kind)
    def found(values: pd.Series) -> pd.Series:
        out = []
        for text in values:
            try:
                out.append([{"kind": k, "name": n, "text": s, "error_code": None} for k, n, s in sections(text)])
            except ElementTree.ParseError:
                out.append([{"kind": None, "name": None, "text": None, "error_code": "INVALID_XML"}])
        return pd.Series(out)

    d = df.select(key, F.posexplode(found(F.col(body))).alias("n", "_s"))
    return d.select(key, "n", "_s.kind", "_s.name", "_s.text", "_s.error_code")


def body_format(body: Column) -> Column:
    """json, xml, or other, by a text's first sign."""
    first = F.substring(F.regexp_replace(body, "^[\\s\\ufeff]+", ""), 1, 1)
    return F.when(body.isNull(), F.lit(None).cast("string")).when(first.isin("{", "["), "json").when(first == "<", "xml").otherwise("other")


@F.pandas_udf(T.ArrayType(T.StringType()))
def find_values(bodies: pd.Series, keys: pd.Series) -> pd.Series:
    """All scalars under a key at any depth of a JSON or XML text, in order, as text; none for a text that is neither."""
    import json

    def walk(value, key: str) -> Iterator[str]:
        if isinstance(value, dict):
            for k, v in value.items():
                if k == key and not isinstance(v, (dict, list)) and v is not None:
                    yield json.dumps(v) if isinstance(v, bool) else str(v)
                yield from walk(v, key)
        elif isinstance(value, list):
            for v in value:
                yield from walk(v, key)

    def one(text: str | None, key: str) -> list[str]:
        if not text or not text.strip():
            return []
        try:
            if text.lstrip("﻿ \t\r\n")[:1] == "<":
                return [(e.text or "").strip() for e in parsed_xml(text).iter() if local(e.tag) == key and not len(e)]
            return list(walk(json.loads(text.lstrip("﻿")), key))
        except (ValueError, ElementTree.ParseError, RecursionError):
            return []

    return pd.Series([one(a, b) for a, b in zip(bodies, keys, strict=True)])


def first_int(body: Column, key: str) -> Column:
    """The first whole number under a key."""
    return F.get(F.filter(F.transform(find_values(body, F.lit(key)), lambda x: x.try_cast("long")), lambda x: x.isNotNull()), F.lit(0))


def inspect_csv(files: DataFrame, header: list[str]) -> DataFrame:
    """(path, rows, encoding, error, valid): whether a file is CSV in UTF-8 or CP949 with exactly this header and as wide rows, and how many."""

    def look(content: bytes) -> tuple[int | None, str | None, str | None]:
        for encoding in ("utf-8-sig", "cp949"):
            try:
                text = content.decode(encoding)
                break
            except UnicodeDecodeError:
                continue
        else:
            return None, None, "ENCODING"
        name = "UTF-8" if encoding == "utf-8-sig" else "CP949"
        try:
            reader = csv.reader(io.StringIO(text, newline=""), strict=True)
            first = next(reader, None)
            if first is None:
                return 0, name, "EMPTY"
            if first != header:
                return None, name, "HEADER"
            n = 0
            for row in reader:
                if len(row) != len(header):
                    return n, name, "WIDTH"
                n += 1
            return n, name, None if n else "NO_ROWS"
        except csv.Error:
            return None, name, "SYNTAX"

    return _per_file(files, "rows long, encoding string, error string", lambda content: [look(content)]).withColumn("valid", F.col("error").isNull())


def _per_file(files: DataFrame, schema: str, read: Callable[[bytes], list[tuple]]) -> DataFrame:
    """(path, ...) rows of every file; ``read`` returns rows for a file's bytes."""
    fields = [x.split() for x in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    names = ["path", *(n for n, _ in fields)]
    types = [pa.string(), *(kinds[k] for _, k in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                path, content = batch.column("path")[k].as_py(), batch.column("content")[k].as_py()
                rows = [(path, *r) for r in read(content or b"")]
                for at in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 10_000], strict=True), types, strict=True)], names)

    return files.select("path", "content").mapInArrow(run, f"path string, {schema}")


class Package(zipfile.ZipFile):
    """A zip file whose members may be read as far as the bounds allow."""

    def __init__(self, content: bytes):
        super().__init__(io.BytesIO(content))
        infos = self.infolist()
        if len(infos) > MAX_MEMBERS or sum(i.file_size for i in infos) > MAX_INFLATED:
            raise ValueError("TOO_LARGE")
        if any(i.flag_bits & 1 for i in infos):
            raise ValueError("ENCRYPTED")

    def xml(self, name: str) -> ElementTree.Element:
        return parsed_xml(self.read(name).decode("utf-8-sig"))


def guarded(read: Callable[[bytes], Iterator[tuple]], width: int) -> Callable[[bytes], list[tuple]]:
    """Rows of a package and a null ``error_code``, or one row of nulls with the code."""

    def safe(content: bytes) -> list[tuple]:
        try:
            return [(*r, None) for r in read(content)]
        except ValueError as e:
            code = str(e) if str(e) in ("TOO_LARGE", "ENCRYPTED", "UNSUPPORTED") else "PACKAGE"
        except (zipfile.BadZipFile, zlib.error, ElementTree.ParseError, RuntimeError, KeyError, EOFError, OSError, NotImplementedError):
            code = "PACKAGE"
        return [(*[None] * width, code)]

    return safe


_SECTION = re.compile(r"(?:^|/)section(\d+)\.xml$", re.I)


def hwpx_sections(z: Package) -> list[str]:
    """Section parts in the order of the package's spine; by their numbers where it has none."""
    names = set(z.namelist())
    content = next((n for n in names if n.endswith("content.hpf")), None)
    ordered: list[str] = []
    if content:
        root, folder = z.xml(content), content.rpartition("/")[0]
        items = {e.get("id"): e.get("href", "") for e in root.iter() if local(e.tag) == "item"}
        for e in root.iter():
            if local(e.tag) == "itemref" and (href := items.get(e.get("idref"))):
                name = next((n for n in (href, f"{folder}/{href}") if n in names), None)
                if name and _SECTION.search(name) and name not in ordered:
                    ordered.append(name)
    return ordered + sorted((n for n in names if _SECTION.search(n) and n not in ordered), key=lambda n: int(_SECTION.search(n)[1]))


def hwpx_blocks(files: DataFrame) -> DataFrame:
    """(path, section, n, kind, table_no, row_no, col_no, text, error_code): paragraphs and table cells of a package in the order of its spine.

    A cell's place is the one that it states, else the one that it stands at; paragraphs of one cell are rows of their own.
    """

    def blocks(content: bytes) -> Iterator[tuple]:
        with Package(content) as z:
            n = tables = 0
            for section, name in enumerate(hwpx_sections(z)):
                stack: list[tuple] = [(z.xml(name), None)]
                while stack:
                    node, cell = stack.pop()
                    tag = local(node.tag)
                    if tag == "p":
                        own = "".join(t.text or "" for run in node if local(run.tag) == "run" for t in run if local(t.tag) == "t").strip()
                        if own:
                            yield section, n, "cell" if cell else "paragraph", *(cell or (None, None, None)), unicodedata.normalize("NFC", own)
                            n += 1
                    if tag == "tbl":
                        tables += 1
                        cells = []
                        for r, tr in enumerate(e for e in node if local(e.tag) == "tr"):
                            for c, tc in enumerate(e for e in tr if local(e.tag) == "tc"):
                                at = next((e for e in tc if local(e.tag) == "cellAddr"), None)
                                place = (int(at.get("rowAddr", r)), int(at.get("colAddr", c))) if at is not None else (r, c)
                                cells.append((tc, (tables - 1, *place)))
                        direct = [(e, cell) for e in node if local(e.tag) == "tc"]
                        stack += [*reversed(cells), *reversed(direct)] if not direct else [(e, (tables - 1, 0, k)) for k, (e, _) in reversed(list(enumerate(direct)))]
                        continue
                    stack += [(c, cell) for c in reversed(node)]

    return _per_file(files, "section int, n int, kind string, table_no int, row_no int, col_no int, text string, error_code string", guarded(blocks, 7))


def _text_blocks(content: bytes) -> Iterator[tuple[str, str]]:
    text = content.decode("utf-8-sig", "strict") if not content.startswith((b"\xff\xfe", b"\xfe\xff")) else content.decode("utf-16")
    for part in re.split(r"\n\s*\n", text.replace("\r\n", "\n").replace("\r", "\n")):
        if part.strip():
            yield "paragraph", part.strip()


def _word_blocks(z: Package) -> Iterator[tuple[str, str]]:
    for p in z.xml("word/document.xml").iter():
        if local(p.tag) == "p":
            text = "".join("\t" if local(e.tag) == "tab" else "\n" if local(e.tag) in ("br", "cr") else e.text or "" if local(e.tag) == "t" else "" for e in p.iter())
            if text.strip():
                yield "paragraph", text.strip()


def _sheet_blocks(z: Package) -> Iterator[tuple[str, str]]:
    names = z.namelist()
    strings = ["".join(t.text or "" for t in e.iter() if local(t.tag) == "t") for e in z.xml("xl/sharedStrings.xml") if local(e.tag) == "si"] if "xl/sharedStrings.xml" in names else []
    for name in sorted((n for n in names if re.match(r"xl/worksheets/sheet\d+\.xml$", n)), key=lambda n: int(re.search(r"(\d+)\.xml$", n)[1])):
        for row in (e for e in z.xml(name).iter() if local(e.tag) == "row"):
            cells = []
            for c in row:
                v = next((e.text or "" for e in c if local(e.tag) == "v"), "") if c.get("t") != "inlineStr" else "".join(t.text or "" for t in c.iter() if local(t.tag) == "t")
                cells.append(strings[int(v)] if c.get("t") == "s" and v.isdigit() and int(v) < len(strings) else v)
            if any(x.strip() for x in cells):
                yield "row", "\t".join(cells).rstrip()


def _slide_blocks(z: Package) -> Iterator[tuple[str, str]]:
    for name in sorted((n for n in z.namelist() if re.match(r"ppt/slides/slide\d+\.xml$", n)), key=lambda n: int(re.search(r"(\d+)\.xml$", n)[1])):
        for p in (e for e in z.xml(name).iter() if local(e.tag) == "p"):
            text = "".join(e.text or "" for e in p.iter() if local(e.tag) == "t").strip()
            if text:
                yield "paragraph", text


def document_blocks(files: DataFrame, depth: int = 1) -> DataFrame:
    """(path, member, n, kind, start, stop, text, error_code): NFC blocks of texts, word documents, sheets, slides, packages and archives of these.

    A file's text is its blocks joined by an empty line; ``start`` and ``stop`` are code points in it. Members of an archive are documents of their own, ``depth`` levels down, an unknown
    one having the code UNSUPPORTED.
    """

    def kind_of(content: bytes, z: Package | None) -> str:
        names = set(z.namelist()) if z else set()
        if "word/document.xml" in names:
            return "word"
        if any(n.startswith("xl/worksheets/") for n in names):
            return "sheet"
        if any(n.startswith("ppt/slides/") for n in names):
            return "slide"
        if any(_SECTION.search(n) for n in names):
            return "hwpx"
        return "archive" if z else "text"

    def hwpx(z: Package) -> Iterator[tuple[str, str]]:
        for name in hwpx_sections(z):
            for p in z.xml(name).iter():
                if local(p.tag) == "p":
                    own = "".join(t.text or "" for run in p if local(run.tag) == "run" for t in run if local(t.tag) == "t").strip()
                    if own:
                        yield "paragraph", own

    def read(content: bytes, member: str, level: int, budget: list[int]) -> Iterator[tuple]:
        budget[0] -= len(content)
        if budget[0] < 0:
            raise ValueError("TOO_LARGE")
        z = Package(content) if content[:4] in (b"PK\x03\x04", b"PK\x05\x06") else None
        kind = kind_of(content, z)
        if kind == "archive":
            for name in z.namelist() if level else []:
                if not name.endswith("/"):
                    own = f"{member}/{name}" if member else name
                    yield from ((own, *r[1:]) if r[0] == member else r for r in safe(z.read(name), own, level - 1, budget))
            return
        if kind == "text" and (b"\x00" in content[:4096] and not content.startswith((b"\xff\xfe", b"\xfe\xff")) or content[:4] in (b"%PDF", b"\xd0\xcf\x11\xe0")):
            raise ValueError("UNSUPPORTED")
        parts = {"word": _word_blocks, "sheet": _sheet_blocks, "slide": _slide_blocks, "hwpx": hwpx}.get(kind)
        at = 0
        for n, (block, text) in enumerate(parts(z) if parts else _text_blocks(content)):
            text = unicodedata.normalize("NFC", text)
            yield member, n, block, at, at + len(text), text, None
            at += len(text) + 2

    def safe(content: bytes, member: str, level: int, budget: list[int]) -> list[tuple]:
        try:
            return list(read(content, member, level, budget))
        except UnicodeDecodeError:
            code = "UNSUPPORTED"
        except ValueError as e:
            code = str(e) if str(e) in ("TOO_LARGE", "ENCRYPTED", "UNSUPPORTED") else "PACKAGE"
        except (zipfile.BadZipFile, zlib.error, ElementTree.ParseError, RuntimeError, KeyError, EOFError, OSError, NotImplementedError):
            code = "PACKAGE"
        return [(member, None, None, None, None, None, code)]

    return _per_file(files, "member string, n int, kind string, start long, stop long, text string, error_code string", lambda content: safe(content, "", depth, [MAX_INFLATED]))


def tiling_issues(blocks: DataFrame, texts: DataFrame, key: str, gap: int = 2) -> DataFrame:
    """(key, issue): files whose blocks don't tile their text: numbers in a row, each block ``gap`` after the one before, the first at 0, the last at the end, the text of each its own."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy("n")
    b = blocks.withColumns({"_n": F.row_number().over(w) - 1, "_s": F.coalesce(F.lag("stop").over(w) + gap, F.lit(0))}).join(texts.select(key, F.col("text").alias("_t")), key)
    own = F.substring(F.col("_t"), F.col("start").cast("int") + 1, (F.col("stop") - F.col("start")).cast("int"))
    a = b.groupBy(key).agg(F.bool_or((F.col("n") != F.col("_n")) | (F.col("start") != F.col("_s")) | ~own.eqNullSafe(F.col("text"))).alias("bad"), F.max("stop").alias("end"), F.first(F.length("_t")).alias("size"))
    return a.where("bad OR end <> size").select(key, F.when(F.col("bad"), "BLOCKS_DO_NOT_TILE").otherwise("TEXT_NOT_COVERED").alias("issue"))


def block_lines(lines: DataFrame, blocks: DataFrame, keys: list[str], cell: int = 4096) -> DataFrame:
    """(keys, line_no, n) of the lines and blocks (both start, stop) that overlap, and each line without a block with a null n: a range join in cells, no pairs of a whole field."""
    from ..operators.rules import range_overlap

    a = lines.withColumn("_k", F.xxhash64(*keys))
    b = blocks.withColumn("_k", F.xxhash64(*keys))
    both = range_overlap(a, b, "_k", "start", "stop", cell)
    same = [F.col("l")[k].eqNullSafe(F.col("r")[k]) for k in keys]
    found = both.where(reduce(lambda x, y: x & y, same)).select(*[F.col("l")[k].alias(k) for k in keys], F.col("l.line_no").alias("line_no"), F.col("r.n").alias("n"))
    return lines.select(*keys, "line_no").join(found, [*keys, "line_no"], "left")


# --- tab-separated catalogues ---


def tab_rows(files: DataFrame, header: list[str]) -> DataFrame:
    """(path, line, fields..., error_code) of UTF-8 files of tab-separated rows without quoting: an exact header, exact widths; NUL and other encodings are errors."""

    def read(content: bytes) -> list[tuple]:
        none = [None] * len(header)
        try:
            lines = content.decode("utf-8-sig").replace("\r\n", "\n").split("\n")
        except UnicodeDecodeError:
            return [(0, *none, "ENCODING")]
        if lines and not lines[-1]:
            lines.pop()
        if not lines or lines[0].split("\t") != header:
            return [(1, *none, "HEADER")]
        out = []
        for n, line in enumerate(lines[1:], 2):
            row = line.split("\t")
            out.append((n, *none, "WIDTH" if len(row) != len(header) else "NUL") if len(row) != len(header) or "\x00" in line else (n, *row, None))
        return out

    fields = [f"f{k}" for k in range(len(header))]
    d = _per_file(files, "line long, " + ", ".join(f"{f} string" for f in fields) + ", error_code string", read)
    return d.select("path", "line", *[F.col(f).alias(h) for f, h in zip(fields, header, strict=True)], "error_code")


def decimal_field(text: Column, scale: int = 4) -> Column:
    """A plain decimal number (sign, digits, fraction), else null."""
    return F.when(text.rlike(r"^-?[0-9]{1,14}(\.[0-9]+)?$"), text.try_cast(f"decimal(18,{scale})"))


def flag_field(text: Column) -> Column:
    """Y and N as booleans; n/a and empty are null, as anything else is."""
    return F.when(text == "Y", True).when(text == "N", False)
