"""Main texts of pages: templates against plain occurrence vectors, parts of pages, and broken markup."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from agroloom.llm import page_text
from agroloom.llm.html_tokens import TEXT, Reader

PAGES = "page_id bigint, url string, html string, host string, text string, classes string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z") for i, u, h in rows], PAGES)


def texts(spark, rows) -> list:
    got = page_text.extracted(pages(spark, rows)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return sorted(((r["page_id"], r["url"], r["text"]) for r in got), key=repr)


def alone(html: str) -> str:
    return page_text.main_text(Reader().read(html), None, set())


@pytest.mark.parametrize(
    ("html", "wanted"),
    [
        ("", ""),
        ("only text", "only text"),
        ("<p>one<p>two</p>three", "one\ntwo\nthree"),
        ("<p>a  <b>b\n</b>c&nbsp;&amp;&lt;d&#33;<br>e</p>", "a b c &<d! e"),
        ("<html><head><title>t</title><style>p{}</style></head><body><p>x</p>", "x"),
        ("<script>var a='</p><p>no';</script><p>yes</p><noscript>no</noscript>", "yes"),
        ("<nav>menu</nav><article><h1>T</h1><p>a<p><b>b</article><footer>f</footer>", "T\na\nb"),
        ("<div class='site-header'>h</div><main><h1>T</h1><p>a</p><div id='comments'><article>c</article></div></main>", "T\na"),
        ("<div class='no-sidebar wrap'><article><p>a</p></article></div>", "a"),
        ("<article></article><div class='ad'>buy</div>", ""),
        ("<div class='text'><p>a</p></div><div class='cookie-notice'>we use</div><form><p>mail</p></form>", "a"),
        ("<article><header><h1>T</h1></header><p>a <a href='x'>link</a> b</p><aside>c</aside></article>", "T\na link b"),
        ("<p>a &lt; b &am c &copy", "a < b &am c ©"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<p title='a > b'>x</p><p title='unclosed>y</p>", "x\ny"),
        ("<p>x</p><!-- no > <p>no</p> --><p>y</p><!-- open <p>no", "x\ny"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><td>f</table>", "a\nb\nc\nd\ne\nf"),
        ("<p>x</p><p hidden>no</p><p style='display: none'>no</p><div aria-hidden='true'>no</div>", "x"),
        ("<p>x<div", "x"),
        ("</p></div><b>x</i></b>", "x"),
    ],
)
def test_parts_of_a_page(html, wanted):
    assert alone(html) == wanted


def site(k: int, article: str) -> str:
    links = "".join(f"<li><a href='/{k}-{j}'>Story number {k * j} of today</a></li>" for j in range(3 + k % 4))
    return (
        f"<html><body><div class='c1'><div class='c2'>Our site, since 1999</div><div class='c3'><ul>{links}</ul></div>"
        f"<div class='c4'><h1>Title {k}</h1>{article}<div class='c5'>Print this page</div></div></div></body></html>"
    )


def test_a_template_is_told_from_its_data_without_names(spark):
    articles = {k: "".join(f"<p>Sentence {j} of {k}.</p>" for j in range(1 + k % 5)) for k in range(12)}
    rows = [(k, f"http://a.example/{k}", site(k, a)) for k, a in articles.items()]
    wanted = [
        (k, f"http://a.example/{k}", "\n".join([f"Title {k}", *(f"Sentence {j} of {k}." for j in range(1 + k % 5))])) for k in articles
    ]
    assert texts(spark, rows) == sorted(wanted, key=repr)


def test_a_text_on_all_pages_of_a_small_host_stays(spark):
    rows = [(k, f"http://b.example/{k}", "<article><p>The same everywhere.</p></article>") for k in range(4)]
    assert {t for _, _, t in texts(spark, rows)} == {"The same everywhere."}
    copies = [(k, f"http://b.example/{k}", "<article><p>The same everywhere.</p></article>") for k in range(40)]
    assert {t for _, _, t in texts(spark, copies)} == {"The same everywhere."}


def test_odd_rows(spark):
    rows = [
        (1, None, "<p>a</p>"), (1, None, "<p>a</p>"), (None, "http://c.example", None), (2, "not a url", ""),
        (3, "https://user@C.example:80/x", "<p>b</p>"), (4, "http://c.example/long", "<p>" + "word " * 400_000 + "</p>" + "<b>" * 20_000),
    ]
    got = texts(spark, rows)
    assert [(i, u) for i, u, _ in got] == [(i, u) for i, u, _ in sorted(rows, key=lambda r: repr((r[0], r[1])))]
    by_id = {i: t for i, _, t in got}
    assert (by_id[1], by_id[None], by_id[2], by_id[3], len(by_id[4])) == ("a", "", "", "b", 5 * 400_000 - 1)
    assert texts(spark, []) == []


def test_classes_are_those_of_plain_occurrence_vectors(spark):
    rows = [(k, f"http://d.example/{k}", site(k, f"<p>x{k}</p>" * (k % 3))) for k in range(15)]
    found = page_text.equivalence_classes(page_text._pages(pages(spark, rows))).collect()
    got = {(frozenset(r["tags"]), frozenset(r["texts"])) for r in found}
    vectors = defaultdict(lambda: [0] * len(rows))
    is_text = {}
    for at, (_, _, html) in enumerate(rows):
        for token, n in Counter(t for t, _, _ in Reader().read(html)).items():
            vectors[token][at] = n
        is_text |= {t: bool(f & TEXT) for t, f, _ in Reader().read(html)}
    classes = defaultdict(set)
    for token, vector in vectors.items():
        if sum(map(bool, vector)) >= 2:
            classes[tuple(vector)].add(token)
    both = [(frozenset(t for t in c if not is_text[t]), frozenset(t for t in c if is_text[t])) for c in classes.values()]
    wanted = {(tags, texts) for tags, texts in both if len(tags) > 1}
    assert got == wanted and len(wanted) >= 3 and any(texts for _, texts in wanted)
    for r in found:  # in page order
        orders = [[t for t, _, _ in Reader().read(h) if t in set(r["tags"])] for _, _, h in rows]
        longest = max(orders, key=len)
        assert longest[: len(r["tags"])] == r["tags"]


def test_a_class_out_of_order_is_no_part_of_the_template():
    walk = page_text.Walk([(1, [10, 11], []), (2, [20, 21], [88])])
    tokens = [10, 99, 20, 99, 21, 11]
    assert walk.through(tokens, [TEXT if t == 99 else 0 for t in tokens]) == ([(1, 0), (2, 0)], set())
    assert walk.through([20, 88, 99, 21], [0, TEXT, TEXT, 0]) == ([None, (2, 0)], set())
    assert walk.through([11, 10], [0, 0])[1] == {1}
    assert walk.through([10, 20, 11, 21], [0] * 4)[1] == {2}
    assert walk.through([20, 10, 10, 11, 21], [0] * 5)[1] == {1}


def test_a_host_with_most_pages(spark):
    rows = [(k, f"http://{'big' if k % 4 else k}.example/{k}", site(k, f"<p>Only {k}.</p>")) for k in range(400)]
    got = {i: t for i, _, t in texts(spark, rows)}
    assert all(got[k] == f"Title {k}\nOnly {k}." for k in range(400) if k % 4)
