import random
import re
import time

import pytest

from tillwise.llm import html_layout as H

CASES = {
    "a &amp; b": "a & b",
    "<p>One<p>Two <i>it</i>alic<br>three": "One\n\nTwo italic\nthree",
    "<div>a</div><div>b</div>c": "a\nb\nc",
    "<h1>T</h1>x<h2>U</h2>": "T\n\nx\n\nU",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=9><li>x<li>y<br>z</ol>": "9. x\n10. y\n    z",
    "<table><tr><th>Name<th>N<tr><td>apple<td>10<tr><td>fig<td>2000</table>end": "Name   N\napple  10\nfig    2000\n\nend",
    "<table><td>a<td>b</table>": "a  b",
    "<table><tr><td colspan=2>w<td>x<tr><td>1<td>2<td>3</table>": "w     x\n1  2  3",
    "<table><tr><td>a<br>b<td>c</table>": "a  c\nb",
    "<head><title>no</title></head><body>yes": "yes",
    "<script>var t='</p>';</script>x<style>y</style>": "x",
    "<p hidden>no</p><p style='color:red;DISPLAY : none'>no</p><span aria-hidden=true>no</span>yes": "yes",
    "a<!-- <b>no</b> -->b<!doctype html>c": "abc",
    "<pre>a  b\n  c</pre>": "a  b\n  c",
    "<dl><dt>T<dd>D<dt>U<dd>E</dl>": "T\n  D\nU\n  E",
    "<blockquote>q</blockquote>r": "  q\n\nr",
    "x <img alt='pic'> <input type=submit value=Go><input value=no>": "x pic Go no",
    "</div>stray</p> <b>un<i>closed": "stray unclosed",
    "1 < 2 & 3 > 2": "1 < 2 & 3 > 2",
    "<p>a   \n b</p>": "a b",
    "<a href='x>y'>l</a>": "l",
    "a<textarea>\n<b>typed</b>\n  &amp; kept</textarea>z": "a\n<b>typed</b>\n  & kept\nz",
    "<input value=Ann><input type=password value=no><input type=hidden value=no><input type=EMAIL value=a@b>": "Ann a@b",
    "<table><tr><td rowspan=2>A<td>b<tr><td>c<td>d</table>": "A  b\n   c  d",
    "<table><tr><td>x<td rowspan=3 colspan=2>S<td>y<tr><td>1<td>2<tr><td>3<td>4<tr><td>5<td>6</table>": "x  S    y\n1       2\n3       4\n5  6",
    "<table><tbody><tr><td rowspan=0>A<td>b<tr><td>c<tbody><tr><td>d</table>": "A  b\n   c\nd",
    "<ol><li>a<li value=7>b<li>c<li value=x>d</ol>": "1. a\n7. b\n8. c\n9. d",
    "<div style='visibility:hidden'>no<p style='visibility: visible'>yes<b>too</b></p>no</div>z": "yestoo\n\nz",
    "<ul><li style=visibility:hidden>no<li>b</ul><table><tr style='visibility:collapse'><td>no<tr><td>c</table>": "- b\n\nc",
    "<div style='visibility:hidden;display:none'><p style='visibility:visible'>no</div>z": "z",
    "": "",
    "<": "<",
    "<p": "",
}


@pytest.mark.parametrize("page", list(CASES))
def test_layout(page):
    assert H.render(page) == CASES[page]


def test_null_deep_and_long_pages():
    assert H.render(None) == ""
    assert H.render("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>after") == "deep\n\nafter"
    assert len(H.render("<p>word " * 50_000).split()) == 50_000
    assert H.render("<ul><li>" * 400 + "x").split()[-1] == "x"


@pytest.mark.parametrize("inside", ["<p hidden>SECRET</p><p>seen", "<ul><li>a<li>b</ul>", "<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "</div>x<p>y</p></b>z"])
def test_depth_changes_nothing(inside):
    shallow, deep = (H.render("<div>" * n + inside + "</div>" * n + "<h1>end") for n in (30, 300))
    assert deep == shallow and "SECRET" not in deep
    assert H.render("<section><i>" * 20_000 + inside) == H.render("<section><i>" * 2 + inside)


def test_many_open_elements_take_linear_time():
    page = "<p>" + "<b>" * 30_000 + "<div>" * 30_000 + "x" + "</span>" * 30_000
    start = time.perf_counter()
    assert H.render(page) == "x"
    assert time.perf_counter() - start < 20


def test_spark(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a"), (None, "u", "<b>b"), (2, None, None), (1, "u", "<p>a")], "page_id long, url string, html string").selectExpr("*", "'clash' AS text")
    assert sorted((r.page_id or 0, r.text) for r in H.extract_text(pages).collect()) == [(0, "b"), (1, "a"), (1, "a"), (2, "")]
    assert H.extract_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, want",
    [
        ("a <math><mi>x</mi><mo>=</mo><mn>2</mn><mspace/><annotation>no</annotation></math> b", "a x=2 b"),
        ("<p>a<svg><title>no</title><defs><text>no</text></defs>" + "<path d='M0'/>" * 400 + "<text>one</text><text>two</text></svg>b", "a\none\ntwo\nb"),
        ("<select><optgroup label=Fruit><option>Apple<option>Pear</select>z", "Fruit\nApple\nPear\nz"),
        ("<object data=x>instead</object>", "instead"),
    ],
)
def test_visible_elements_come_out(page, want):
    assert H.render(page) == want


def random_tree(rng, depth=0):
    """(tag, attributes, children) with every end tag; li in lists and td in tr only."""
    kinds = ["text", "text", "b", "div", "p", "ul", "ol", "table", "br", "gone", "unseen", "seen"]
    kind = "text" if depth > 5 else rng.choice(kinds)
    if kind == "text":
        return rng.choice(["one", "two  three", " four", "five ", "&lt;"])
    if kind == "br":
        return ("br", "", [])
    some = lambda: [random_tree(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    flat = lambda: [rng.choice(["one", "two three", "six"])]
    if kind in ("ul", "ol"):
        return (kind, "", [("li", "", some()) for _ in range(rng.randint(1, 3))])
    if kind == "table":
        width = rng.randint(1, 3)
        return (kind, "", [("tr", "", [("td", "", flat()) for _ in range(width)]) for _ in range(rng.randint(1, 3))])
    if kind == "p":
        return (kind, "", [c for c in some() if isinstance(c, str)])
    attributes = {"gone": " hidden", "unseen": " style='visibility:hidden'", "seen": " style='visibility:visible'"}.get(kind, "")
    return ("div" if attributes else kind, attributes, some())


def source(node):
    if isinstance(node, str):
        return node
    tag, attributes, children = node
    return f"<{tag}{attributes}>" + ("" if tag == "br" else "".join(map(source, children)) + f"</{tag}>")


def words_of(node, seen=True):
    """The words a reader sees, in order, by plain recursion over the tree the page was written from."""
    if isinstance(node, str):
        return [node.replace("&lt;", "<")] if seen else []
    tag, attributes, children = node
    if "hidden'" in attributes:
        seen = False
    elif "visible" in attributes:
        seen = True
    elif attributes:
        return []
    inner = [w for child in children for w in words_of(child, seen)]
    return inner if tag == "b" else ["\n", *inner, "\n"] if tag != "br" else ["\n"]


@pytest.mark.parametrize("seed", range(300))
def test_random_trees_show_what_was_written(seed):
    """Words, their order and the breaks between them against a second rendering; and no end tag is needed twice."""
    rng = random.Random(seed)
    nodes = [random_tree(rng) for _ in range(4)]
    page = "".join(map(source, nodes))
    want = " ".join("".join(w for n in nodes for w in words_of(n)).split())
    markers = re.compile(r"^ *(?:(?:- |[0-9]+\. )+|(?:-|[0-9]+\.)$)")
    found = " ".join(markers.sub("", line) for line in H.render(page).split("\n"))
    assert " ".join(found.split()) == want


def test_tables_line_up_as_written():
    """Cells of a column begin at one place, whatever the spans: against the grid that the rows were written from."""
    rng = random.Random(9)
    for _ in range(200):
        columns, rows = rng.randint(2, 5), rng.randint(2, 5)
        owner, cells = {}, []
        for y in range(rows):
            cells.append([])
            for x in range(columns):
                if (y, x) in owner:
                    continue
                wide = 1
                while x + wide < columns and (y, x + wide) not in owner and rng.random() < 0.2:
                    wide += 1
                high = rng.randint(1, rows - y) if rng.random() < 0.3 else 1
                name = f"c{y}{x}" + "w" * rng.randint(0, 4)
                owner |= {(y + j, x + i): name for j in range(high) for i in range(wide)}
                cells[-1].append((name, x, wide, high))
        page = "<table>" + "".join("<tr>" + "".join(f"<td rowspan={h} colspan={w}>{n}</td>" for n, _, w, h in row) + "</tr>" for row in cells) + "</table>"
        lines = [line for line in H.render(page).split("\n")]
        shown = [row for row in cells if row]
        assert len(lines) == len(shown)
        begins = {}
        for line, row in zip(lines, shown):
            assert line.split() == [n for n, *_ in row]
            for name, x, *_ in row:
                begins.setdefault(x, set()).add(line.index(name))
        assert all(len(b) == 1 for b in begins.values()), page
