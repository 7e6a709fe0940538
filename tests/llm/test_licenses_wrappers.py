"""License scans and HTML extraction: edge cases, brute force, alignment."""

import random
import re

import pytest
from pyspark.sql import functions as F

from loomlake.llm import licenses, wrappers


def brute_licenses(text):
    def grams(t):
        w = [x for x in re.split(licenses.SEPARATOR, (t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    own = grams(text)
    return {n for n, t in licenses.TEMPLATES.items() if 100 * len(own & grams(t)) >= 80 * len(grams(t))}


def test_licenses_against_brute_force(spark):
    filler = "lorem ipsum dolor sit amet consectetur "
    texts = [None, "", "MIT License", "no match for this license here at all", filler * 3000 + "RELEASED!! UNDER!! THE!! MIT!! LICENSE!! " + filler * 50]
    texts += [f"{filler * k}{t}{filler * 3}" for k, t in enumerate(licenses.TEMPLATES.values())]
    texts += [" ".join(licenses.TEMPLATES.values()), texts[4]]
    for t in licenses.TEMPLATES.values():  # near the threshold: words changed from the end on
        w = t.split()
        texts += [filler + " ".join(w[:-k] + ["zz"] * k) + " " + filler for k in (1, 2, 4) if len(w) > 12]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"sh": F.lit(1), "k": F.lit("x"), "at": F.lit(2)}).repartition(4)
    got = {(r["doc_id"], r["license"]) for r in licenses.scan(df).collect()}
    assert got == {(i, n) for i, t in enumerate(texts) for n in brute_licenses(t)}
    assert licenses.scan(df.limit(0)).count() == 0
    plan = licenses.scan(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan.split("== Physical Plan ==")[1].replace("Exchange RoundRobin", "")


def test_templates_are_checked(spark):
    with pytest.raises(ValueError):
        licenses.prepared(spark, {"short": "too short"})
    # templates without the usual words
    bare = {"bare": "one two three four five six seven", "long": "alpha beta gamma delta epsilon zeta eta theta iota kappa", "short": "aa bb cc dd ee ff gg"}
    texts = ["x ONE two three four five six seven y", "alpha beta gamma delta epsilon zeta eta theta iota kappa", "alpha beta", "aa bb cc dd ee ff gg", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r["doc_id"], r["license"]) for r in licenses.scan(df, bare).collect()} == {(0, "bare"), (1, "long"), (3, "short")}
    assert licenses.anchors_of(licenses.prepared(spark, licenses.TEMPLATES)) == licenses.ANCHORS
    assert licenses.anchors_of(licenses.prepared(spark, {"short": bare["short"]})) == ()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><a href="/">Site</a> logo</header><nav><ul><li><a href=1>Home</a><li><a href=2>About</a></ul></nav><div class="cookie-notice">We use cookies</div>
<!-- ad --><div class="ad">Buy</div><article class="post"><header><h1>Head&shy;line &amp; more</h1></header><p>One <b>bold
  text</b> here.<p>Two &#233;&nbsp;x &lt;tag&gt;<ul><li>item 1<li>item 2</ul><form><input><button>Send</button> form text</form><aside>side</aside>
<div id="comments"><p>reader says</p></div>{extra}</article><section class="comments"><article class="comment"><p>reader</p></article></section><div id="sidebar">side</div><footer>&copy; foot</footer>"""
TEXT = "Head\xadline & more\nOne bold text here.\nTwo é x <tag>\nitem 1\nitem 2"


def test_extraction(spark):
    plain = "<body><div class='navbar'>nav</div><div id='content'><p>only divs</p><div>more</div></div><ul><li><a href=1>a</a></li><li><a href=2>b</a></li></ul></body>"
    rows = [(i, "http://a.example.com/x", PAGE.replace("{extra}", f"<p>more {i}</p>" * i)) for i in range(4)]
    rows += [(10, "https://b.example.org?q", plain), (11, None, plain), (12, "x", None), (13, "x", ""), (14, "x", "just text & more"), (15, "x", "<p>a <!-- never ends <p>b"), (16, "x", "<p>a<script>x"), (17, "x", '<p class="a>b'), (18, "x", "<article>" + "<p>w</p>" * 5000 + "</article>"), (18, "x", "<p>1 < 2"), (19, "x", "<div hidden>no</div><p>yes<br>line")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("clash"), "text": F.lit(1), "slots": F.lit(2)}).repartition(3)
    got = [(r["page_id"], r["text"]) for r in wrappers.extract(df).collect()]
    assert len(got) == len(rows)
    text = dict(got)
    for i in range(4):
        assert text[i] == TEXT + "".join(f"\nmore {i}" for _ in range(i))
    assert text[10] == text[11] == "only divs\nmore"
    assert [text[k] for k in (12, 13, 14, 15, 16)] == ["", "", "just text & more", "a", "a"]
    assert {t for p, t in got if p == 18} == {"\n".join(["w"] * 5000), "1 < 2"} and text[19] == "yes line"
    assert wrappers.extract(df.limit(0)).count() == 0


def test_wrapper_is_union_free():
    trees = [wrappers.Page(x).tree for x in ("<div><p>a</p></div>", "<div><h2>t</h2><p>a</p><p>b</p><p>c</p></div>", "<div><p>a</p><p>b</p></div>")]
    whole = trees[0]
    for t in trees[1:]:
        whole = wrappers.align(whole, t, wrappers.both_lists)
    assert wrappers.written(whole) == "<div> (<h2> # </h2>)? (<p> # </p>)+ </div>"


def test_fold_nested_repeats():
    def said(letters):
        return wrappers.written(wrappers.fold([["#", [k], False, False] if x == "#" else [x, [], False, False] for k, x in enumerate(letters.split())])).replace("<", "").replace(">", "")

    tidy = lambda x: " ".join(w for w in x.split() if not w.startswith("/")).replace("  ", " ")
    assert "(" not in said("a b c") and said("p p p").startswith("(p")
    assert tidy(said("h p p h p p p")).startswith("(h")


def stream(parts, out):
    for p in parts:
        if p[0] == "#":
            out.append("#")
        elif p[0] == "()":
            stream(p[1], out)
        else:
            out.append("<" + p[0])
            stream(p[1], out)
            out.append(">")
    return out


def accepts(parts, words):
    """Whether the wrapper, as a regular expression, generates a stream; by Python's own engine."""

    def pattern(parts):
        out = ""
        for p in parts:
            one = "(?:# )" if p[0] == "#" else f"(?:{pattern(p[1])})" if p[0] == "()" else f"(?:<{re.escape(p[0])} {pattern(p[1])}> )"
            out += f"(?:{one}{'+' if p[2] else ''}){'?' if p[3] else ''}"
        return out

    return re.fullmatch(pattern(parts), "".join(w + " " for w in words)) is not None


def unfolded(source, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(wrappers, "fold", lambda parts: parts)
        return stream(wrappers.Page(source).tree, [])


def test_wrapper_accepts_the_pages_it_comes_from(monkeypatch):
    r = random.Random(3)
    block = lambda: r.choice(["<p>x</p>", "<h2>t</h2><p>x</p>", "<ul>" + "<li>i</li>" * r.randint(1, 4) + "</ul>", "<div class='box'><p>y</p></div>", "<table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table>"])
    for _ in range(60):
        sources = ["<div>top</div><article>" + "".join(block() for _ in range(r.randint(0, 6))) + "</article>" + r.choice(["", "<div>end</div>"]) for _ in range(4)]
        trees = [wrappers.filled(p.tree, iter(wrappers.page_slots(p))) for p in map(wrappers.Page, sources)]
        whole = wrappers.one_wrapper([{"parts": t, "coarse": False} for t in trees], 3000)["parts"]
        for source in sources:
            assert accepts(whole, unfolded(source, monkeypatch)), (sources, wrappers.written(whole))


NAMES = ["page with-sidebar", "content-sidebar-wrap", "legal-guide", "search-engine-review", "social-policy", "form-guide"]


def test_names_around_the_article_do_not_empty_it(spark):
    rows = [
        (0, f'<div class="content-sidebar-wrap">{"<p>words of the text</p>" * 3}</div>', "\n".join(["words of the text"] * 3)),
        (1, f'<div class="page with-sidebar"><div class="sidebar"><p>side</p></div><div>{"<p>words of the text</p>" * 3}</div></div>', "\n".join(["words of the text"] * 3)),
        (2, '<main><div class="legal-guide"><p>words of law</p></div></main>', "words of law"),
        (3, '<article><div class="search-engine-review"><p>an engine</p></div><div class="share-buttons">tell</div></article>', "an engine"),
        (4, '<article class="social-policy"><p>policy</p></article>', "policy"),
        (5, '<div class="form-guide"><p>how to fill forms in</p></div><form>name</form>', "how to fill forms in"),
        (6, f'<form id="aspnetForm"><nav>menu</nav><div><p>{"all inside a form " * 9}</p></div></form>', ("all inside a form " * 9).strip()),
        (7, "<div>" * 3000 + "<p>deep</p>" + "</div>" * 3000 + "<p>and out</p>", "deep\nand out"),
    ]
    df = spark.createDataFrame([(i, f"http://h{i}.example.com/", h) for i, h, _ in rows], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()} == {i: t for i, _, t in rows}


def site(n, r):
    """Pages of one host whose parts have no telling names, and their article texts."""
    word = lambda k: " ".join("".join(r.choices("abcdeo", k=5)) for _ in range(k))
    out = []
    for k in range(n):
        paras = [word(r.randint(5, 30)) for _ in range(r.randint(1, 6))]
        title = word(3)
        menu = "".join(f"<a href=/{x}>{word(1)}</a><hr>" if r.random() < 2 else "" for x in range(4))
        extra = f'<div class="qx"><p>{word(4)}</p></div>' if r.random() < 0.3 else ""
        body = f'<div class="aa"><p>Welcome to our pages</p></div><div class="bb"><div>{menu}</div></div><div class="cc"><h1>{title}</h1>{"".join(f"<p>{p}</p>" for p in paras)}</div>{extra}<div class="dd"><p>All rights are ours</p><p>Made with care</p></div>'
        out.append((k, f"https://site.example.com/{k}", f"<html><body>{body}</body></html>", "\n".join([title, *paras] + ([re.search("<p>(.*?)</p>", extra)[1]] if extra else []))))
    return out


@pytest.mark.parametrize("fan_in", [32, 2])
def test_wrapper_decides(spark, monkeypatch, fan_in):
    rows = site(40, random.Random(5))
    df = spark.createDataFrame([x[:3] for x in rows], "page_id long, url string, html string").repartition(4)
    monkeypatch.setattr(wrappers, "FAN_IN", fan_in)
    monkeypatch.setattr(wrappers.infer, "__defaults__", (fan_in, wrappers.WRAPPER_PARTS))
    want = {k: t for k, _, _, t in rows}
    for chars in (wrappers.BROADCAST_CHARS, 0):
        assert {r["page_id"]: r["text"] for r in wrappers.extract(df, chars).collect()} == want
    # without the wrapper, equal text and menus of unlisted names stay
    alone = {k: wrappers.Extractor(None).text(wrappers.Page(h)) for k, _, h, _ in rows}
    assert all(alone[k] != want[k] and "Welcome to our pages" in alone[k] for k in want)


def test_near_copies_keep_their_headings(spark):
    rows = [(k, "http://a.example.com/", f'<div class="zz">Our shop sells things</div><div class="yy"><h1>One title</h1><p>{"the same long text on every copy " * 5}</p><p>only on {k}</p></div>') for k in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    same = ("the same long text on every copy " * 5).strip()
    assert {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()} == {k: f"One title\n{same}\nonly on {k}" for k in range(5)}


def test_copies_of_one_page_are_no_template(spark):
    rows = [(k, "http://a.example.com/", "<div><p>the same text on every copy</p></div>") for k in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["text"] for r in wrappers.extract(df).collect()} == {"the same text on every copy"}


def test_large_wrappers_are_written_again_without_names(spark):
    rows = [(k, "http://a.example.com/", f'<div class="x{chr(97 + k % 26)}{chr(97 + k // 26)}q"><p>text {k}</p></div><div class="ad-box">ad {k}</div><div class="y{chr(97 + k % 26)}q"><p>more {k}</p></div>') for k in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert wrappers.infer(df.withColumn("host", F.lit("h")), limit=20).count() == 1
    assert wrappers.one_wrapper([{"parts": wrappers.filled(p.tree, iter(wrappers.page_slots(p))), "coarse": False} for p in (wrappers.Page(h) for _, _, h in rows)], 20)["coarse"]
    assert {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()} == {k: f"text {k}\nmore {k}" for k in range(60)}
