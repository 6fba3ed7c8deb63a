"""Main text: elements, messy markup, templates found from the pages of a host."""

from __future__ import annotations

import html
import random
import re

import pytest

from callmeter.llm import page_text, registry
from callmeter.llm.page_text import Parser
from tests.llm.cases import clashing, sentence

SCHEMA = "page_id long, url string, html string"


def texts(spark, rows):
    found = page_text.main_text(clashing(spark.createDataFrame(rows, SCHEMA)))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    out = found.collect()
    assert all(len(r["text"]) == r["n_chars"] for r in out)
    return [(r["page_id"], r["text"]) for r in out]


def one(spark, page):
    return dict(texts(spark, [(1, "https://x.example/1", page)]))[1]


PAGE = """<!DOCTYPE html><html lang=en><head><title>No</title><style>p{}</style><script>var a = "</p><article>No";</script></head>
<body class="has-sidebar"><header><a href="/">Site</a></header><nav><ul><li>Menu</ul></nav><div class="ad">Buy <p>now</div>
<article><header><h1>Title &amp;  more</h1></header><p>First <b>bold<br>text</b> &eacute;&#33; <!-- no --> end<p>Second<div hidden>no</div>
<form><p>Name <input value="no"></form><ul><li>one<li>two <a title="a > b">link</a></ul><aside>No</aside>
<div id="comments"><p>No</p></div><table><tr><td>cell<td>other</table></article><div role="dialog">No</div>
<footer>No &copy;</footer></body></html>"""


def test_messy_markup(spark):
    assert one(spark, PAGE) == "Title & more\nFirst bold text é! end\nSecond\none\ntwo link\ncell\nother"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>a</p", "a"), ("<p>a<script>b", "a"), ("a < b > c", "a < b > c"),
        ("<main><p>x</p></main><p>y</p>", "x"), ("</p></div>x<br>y", "x y"), ("<nav>x</nav>", ""), ("<p>a</b></i>c<p>", "ac"),
        ("<article><span class='ad'>no</span> yes</article>", "yes"), ("<a '" * 50 + "<p>x", None),
    ],
)
def test_small_pages(spark, page, text):
    found = one(spark, page)
    assert text is None or found == text


LONG = "a text of many words that goes on"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a <svg class='icon'/> b</p><p>c</p><p><math/>d</p>", "a b\nc\nd"),
        ("<p>a <svg><path d=''/> b</p><p>c <svg><text>no</text></svg> d</p>", "a b\nc d"),
        ("<p>a</p><svg><foreignObject><p>no</p></foreignObject></svg><p>b</p>", "a\nb"),
        ("<p>a</p><video src=x><p>b</p><video><p>no</p></video><p>c</p>", "a\nb\nc"),
        ("<p>a</p><object data=x><p>b</p>", "a\nb"),
        ("<p>a</p><select><option>no<option>no</select><p>b</p>", "a\nb"),
        ("<p>a</p><select><option>no<option>no<p>b</p>", "a\nb"),
        ("<p>a</p><textarea>no<p>no</p>", "a"),
        ("<div class='content has-sidebar'><article><p>x</p></article><div class='sidebar'>no</div></div>", "x"),
        (f"<div class='post no-comments'><p>{LONG}</p></div><p>y</p><div class='share'>no</div>", f"{LONG}\ny"),
        (f"<article class='post no-comments'><p>{LONG}</p></article><div class='related'>no</div>", LONG),
        (f"<main><p>{LONG}</p></main><div class='related'><article>{LONG * 9}</article></div>", None),
        (f"<article><p>{LONG}</p></article><div class='related'><article>no</article></div>", LONG),
        (f"<div class='page has-sidebar'><main><p>{LONG}</p><div class='related'><article>no</article></div></main></div>", LONG),
        (f"<div class='post'><p>{LONG}</p></div><div id='comments'><article class='comment'>no</article></div>", LONG),
        (f"<body><form action='/'><div><p>{LONG}</p><p>and more</p></div><input></form></body>", f"{LONG}\nand more"),
        (f"<body><form><article><p>{LONG}</p></article></form><p>no</p></body>", LONG),
        (f"<p>{LONG}</p><p>{LONG}</p><form><p>Your name</p><label>no</label></form>", f"{LONG}\n{LONG}"),
        (f"<div class='post'><p>{LONG * 9}</p></div><article><p>one card</p></article><article><p>a card</p></article>", LONG * 9),
        (f"<article><p>{LONG}</p></article><article><p>a card</p></article><p>no</p>", f"{LONG}\na card"),
        (f"<article><p>{LONG}</p><p class='sponsor-history'>more</p><p class='sponsor'>no</p></article>", f"{LONG}\nmore"),
        (f"<body aria-hidden='true'><p>{LONG}</p></body>", LONG),
        (f"<div aria-hidden='true'><article><p>{LONG}</p></article></div><div aria-hidden='true'>no</div>", LONG),
        (f"<p>{LONG}</p><p>Choose <label>this</label> option now</p>", f"{LONG}\nChoose this option now"),
        (f"<form><article><p>{LONG}</p><label>no</label><p>Tick <label>here</label> too</p></article></form>", f"{LONG}\nTick here too"),
    ],
)
def test_nothing_of_an_article_is_cut(page, text):
    found = page_text._article(page_text.read_page(page), page_text._Template(None))
    assert LONG in found if text is None else found == text


def test_many_open_elements_take_no_square():
    assert len(Parser("<p>x <svg> <video> <option>" * 20000).blocks) == 20000


def site(rng, n, host, article="<div class='post'>{}</div>"):
    """Pages without article elements: a constant notice, a varying teaser list, and a text."""
    rows = []
    for i in range(n):
        blocks = [sentence(rng, rng.randrange(30, 60), 5000) for _ in range(rng.randrange(2, 6))]
        teasers = "".join(f"<div class='t'>{sentence(rng, 2)}</div>" for _ in range(3))
        body = "".join(f"<p>{b}</p>" for b in blocks)
        page = f"<body><div class='top'>Welcome to the site</div><div class='list'>{teasers}</div>{article.format(body)}<div>Call us any time</div></body>"
        rows.append((i, f"https://{host}/{i}", page, "\n".join(blocks)))
    return rows


def test_template_of_a_host(spark):
    rows = site(random.Random(1), 40, "a.example")
    assert sorted(texts(spark, [r[:3] for r in rows])) == [(i, text) for i, _, _, text in rows]


@pytest.mark.parametrize("article", ["<div class='post'>{}</div>", "{}"])
def test_headings_and_lists_of_a_host_without_article_elements(spark, article):
    rng = random.Random(7)
    rows, truth = [], []
    for i in range(20):
        title, under, items, cell = sentence(rng, 4, 5000), sentence(rng, 3, 5000), [sentence(rng, 2, 5000) for _ in range(3)], sentence(rng, 2, 5000)
        first, second = sentence(rng, 300, 5000), sentence(rng, 300, 5000)
        body = f"<h1>{title}</h1><p>{first}</p><h2>{under}</h2><ul>{''.join(f'<li>{x}</li>' for x in items)}</ul><p>{second}</p><table><tr><td>{cell}</td></tr></table>"
        page = f"<body><div class='top'>Welcome</div><div class='t'>{sentence(rng, 2)}</div>{article.format(body)}<div>Call us</div></body>"
        rows.append((i, f"https://h.example/{i}", page))
        truth.append((i, "\n".join([title, first, under, *items, second, cell])))
    assert sorted(texts(spark, rows)) == truth


def test_odd_pages_among_many(spark):
    """A page that swaps two template tokens, one that does not nest them, and a class that encloses a larger one."""
    rng = random.Random(9)
    rows = []
    for i in range(40):
        text = sentence(rng, 80, 5000)
        notices = ["<div class='one'>Welcome</div>", "<div class='two'>Call us</div>", "<div class='three'>Open daily</div>"]
        if i == 7:
            notices.reverse()
        body = f"{notices[0]}<div class='post'><p>{text}</p></div>{notices[1]}{notices[2]}"
        if i == 9:
            body = f"<div class='post'><p>{text}</p></div>{''.join(notices)}"
        around = "<div class='line'>Again</div>" * 2
        rows.append((i, f"https://o.example/{i}", f"<body>{around[: len(around) // 2]}{body}{around[len(around) // 2 :]}</body>", text))
    assert sorted(texts(spark, [r[:3] for r in rows])) == [(i, text) for i, _, _, text in rows]


def test_templates_joined_instead_of_broadcast(spark, monkeypatch):
    monkeypatch.setattr(page_text, "BROADCAST_BYTES", 0)
    rows = site(random.Random(2), 20, "a.example") + [(100 + i, u, p, t) for i, u, p, t in site(random.Random(3), 20, "b.example")]
    assert sorted(texts(spark, [r[:3] for r in rows])) == [(i, text) for i, _, _, text in rows]


def test_copies_of_an_article_stay(spark):
    rows = [(i, f"https://c.example/{i}", "<article><h1>Same</h1><p>Same text</p></article><p>Same notice</p>") for i in range(20)]
    assert {t for _, t in texts(spark, rows)} == {"Same\nSame text"}


def test_pairs_that_hold():
    def held(page, *classes):
        return page_text.held_pairs(list(page), [list(c) for c in classes])

    assert held("xaybz", "ab") == [[True]]
    assert held("xbyaz", "ab") == [[False]]
    assert held("ababab", "ab") == [[True]] and held("aabb", "ab") == [[False]] and held("aba", "ab") == [[False]]
    assert held("abc", "abc") == [[True, True]] and held("acb", "abc") == [[True, False]]
    # Tuples of another class lie between two tokens as a whole, or around them, but are not cut.
    assert held("acdb", "ab", "cd") == [[True], [True]]
    assert held("cabd", "ab", "cd") == [[True], [True]]
    assert held("acbd", "ab", "cd") == [[False], [False]] or held("acbd", "ab", "cd") == [[False], [True]]
    assert held("", "ab") == [[False]]


def plain_template(pages):
    """The template of a host, straight from the definition."""
    pages = list(dict.fromkeys(pages))
    read = [page_text.read_page(p).tokens.tolist() for p in pages]
    if len(read) < page_text.LEAST_PAGES:
        return set()
    vectors = {}
    for token in {x for r in read for x in r}:
        vector = tuple(r.count(token) for r in read)
        if sum(n > 0 for n in vector) >= page_text.SUPPORT * len(read):
            vectors.setdefault(vector, []).append(token)

    def mean_place(token):
        at = [r.index(token) for r in read if token in r]
        return sum(at) / len(at), token

    classes = [sorted(tokens, key=mean_place) for tokens in vectors.values() if len(tokens) > 1]

    def tuples(r, c):
        at = [[k for k, x in enumerate(r) if x == token] for token in c]
        return [(min(x), max(x)) for x in zip(*at, strict=True)] if len({len(x) for x in at}) == 1 else []

    def holds(r, a, b):
        only = [x for x in r if x in (a, b)]
        if not only or only != [a, b] * (len(only) // 2):
            return False
        at = [k for k, x in enumerate(r) if x in (a, b)]
        cut = [s for c in classes for s in tuples(r, c)]
        return not any(low < s < high < e for low, high in zip(at[::2], at[1::2], strict=True) for s, e in cut)

    out = set()
    for c in classes:
        for a, b in zip(c[:-1], c[1:], strict=True):
            if sum(holds(r, a, b) for r in read) >= page_text.SUPPORT * len(read):
                out |= {a, b}
    return out


def found_templates(spark, rows):
    distinct = page_text._distinct_pages(page_text._parse(spark.createDataFrame(rows, SCHEMA)))
    parts = page_text._valid_parts(distinct, page_text.cut_lineage(page_text._classes(distinct)))
    return {r["host"]: set(r["template"]) for r in parts.collect()}


def test_templates_against_the_definition(spark):
    rng = random.Random(11)
    hosts = {"two.example": 2, "three.example": 3, "five.example": 5, "many.example": 24}
    rows, truth = [], {}
    for host, n in hosts.items():
        pages = []
        for i in range(n):
            parts = ["<div class='top'>Welcome</div>", f"<div class='post'><p>{sentence(rng, 9)}</p></div>", "<ul><li>Menu<li>More</ul>", "<div>Call us</div>"]
            if rng.random() < 0.1:
                rng.shuffle(parts)
            parts += [f"<p>{sentence(rng, 2, 3)}</p>" for _ in range(rng.randrange(3))]
            pages.append("".join(parts))
        pages.append(pages[0])
        rows += [(len(rows), f"https://{host}/{i}", p) for i, p in enumerate(pages)]
        truth[host] = plain_template(pages)
    assert found_templates(spark, rows) == {host: t for host, t in truth.items() if t}
    assert truth["two.example"] == set() and len(truth["three.example"]) > 4 and len(truth["many.example"]) > 4


def test_occurrence_vectors_decide(spark, monkeypatch):
    """A line that most pages of a host hold, with a vector of its own, is data; were all vectors equal, it would be template."""
    rng = random.Random(12)
    rows, truth = [], []
    for i in range(40):
        text = [sentence(rng, 40, 5000), sentence(rng, 40, 5000)]
        shared = [] if i in (5, 17) else ["Breaking news of the day"]
        body = "".join(f"<p>{x}</p>" for x in [text[0], *shared, text[1]])
        rows.append((i, f"https://v.example/{i}", f"<body><div class='top'>Welcome</div><div class='post'>{body}</div><div>Call us</div></body>"))
        truth.append((i, "\n".join([text[0], *shared, text[1]])))
    assert sorted(texts(spark, rows)) == truth
    plain = page_text._occurrences
    monkeypatch.setattr(page_text, "_occurrences", lambda distinct: plain(distinct).withColumn("vector", page_text.F.lit(0).cast("long")))
    assert sorted(texts(spark, rows)) != truth


def test_small_hosts_follow_the_same_rule(spark):
    for n in (3, 4, 5):
        rows = site(random.Random(20 + n), n, "s.example")
        assert sorted(texts(spark, [r[:3] for r in rows])) == [(i, text) for i, _, _, text in rows]


def test_a_page_is_parsed_once(spark, monkeypatch):
    rows = [r[:3] for r in site(random.Random(30), 20, "p.example")]
    parsed = spark.sparkContext.accumulator(0)
    plain = page_text.Parser

    def counted(html):
        parsed.add(1)
        return plain(html)

    monkeypatch.setattr(page_text, "Parser", counted)
    assert len(texts(spark, rows)) == 20 and parsed.value == 20


def test_rows_that_repeat_and_nulls(spark):
    rows = [(1, None, "<p>x</p>"), (1, None, "<p>x</p>"), (None, "no address", "<p>y</p>"), (2, "https://d.example", None)]
    assert sorted(texts(spark, rows), key=repr) == sorted([(1, "x"), (1, "x"), (None, "y"), (2, "")], key=repr)
    assert texts(spark, spark.createDataFrame([], SCHEMA).collect()) == []


def test_query_on_given_tables(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = registry.QUERIES["op1_main_text"](spark, sf_dir).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(b.split()) for b in blocks]
        assert r["text"] == "\n".join(b for b in blocks if b)
