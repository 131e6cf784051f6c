import html
import random
import re
import time

import pytest
from conftest import SF_DIR

from stammwerk.llm.html_text import (
    blocks,
    container,
    extract_pages,
    host_of,
    main_text,
    match_trees,
    outline,
    parse,
    tree_of,
)

SHOP = ("<html><body><header>Shop</header><div class='page'><div class='promo-box'>Buy {0}</div>"
        "<div class='content'><h1>{0}</h1><p>About {0}&amp;more.</p><p>Sold by us since 1990.</p>{1}</div>"
        "<section id='reader-comments'><p>{0} is nice</p></section></div>"
        "<footer>&copy; {0}</footer></body></html>")
SCHEMA = "page_id bigint, url string, html string, host string, text string, container int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "t", 1) for r in rows], SCHEMA)


def texts(frame):
    return {r.page_id: r.text for r in extract_pages(frame).collect()}


@pytest.mark.parametrize("source, text", [
    (None, ""),
    ("", ""),
    ("plain  text\n", "plain text"),
    ("<p>a<b>b</b>c &lt;p&gt; &amp; &#233;&nbsp;x", "abc <p> & é x"),
    ("<p>one<p>two<br>three", "one two three"),
    ("<ul><li>a<li>b</ul><ol><li>c</li></ol>", "a b c"),
    ("<nav>m</nav><p>x</p><aside>s</aside><form><p>f</form><p>y</p><footer>z</footer>", "x y"),
    ("<script>if (a < b) '<p>no</p>'</script><style>p{}</style>ok<!-- <p>no</p> -->", "ok"),
    ("<div class='ad'>no</div><div class='add'>yes</div><div id='cookie-notice'>no</div>", "yes"),
    ("<div><p>deep</div>after</p><p>last", "deep after last"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
    ("a</b></div>b <unclosed attr='", "ab <unclosed attr='"),
    ("<div hidden>no</div><p style='display:none'>no</p>yes", "yes"),
])
def test_blocks(source, text):
    assert " ".join(t for _, t in blocks(parse(source))) == text


def test_a_deep_page_does_not_end_the_task():
    source = "<div>" * 3000 + "bottom" + "</div>" * 3000
    assert main_text(source, None, set()) == "bottom"
    assert len(match_trees(tree_of(outline(parse(source))), tree_of(outline(parse(source))))) > 100


def test_container():
    assert container({}) == ""
    assert container({"/html/body/article": 90, "/html/body": 10}) == "/html/body/article"
    assert container({"/html/body/main/section": 99, "/html/body/main": 1}) == "/html/body/main"
    assert container({"/b/x": 50, "/b/y": 50}) == "/b"


def test_matching_aligns_what_both_have():
    a = tree_of(outline(parse("<h1>t</h1><p>one</p><p>two</p><ul><li>x</li></ul>")))
    b = tree_of(outline(parse("<h1>u</h1><p>new</p><p>one</p><p>two</p>")))
    pairs = [(x[0], x[1] == y[1]) for x, y in match_trees(a, b)]
    assert sorted(pairs) == sorted([("root", True), ("h1", False), ("p", True), ("p", True)])


def test_wrapper_leaves_out_what_all_pages_say(spark):
    rows = [(k, f"http://shop.example/{k}", SHOP.format(f"thing{k}", f"<p>Extra {k}</p>" if k % 2 else ""))
            for k in range(30)]
    found = texts(pages(spark, rows))
    for k in range(30):
        extra = f" Extra {k}" if k % 2 else ""
        assert found[k] == f"thing{k} About thing{k}&more.{extra}"


def test_copies_of_a_page_keep_their_text(spark):
    page = "<body><nav>m</nav><article><h1>A</h1><p>b c</p></article></body>"
    other = page.replace("b c", "d e f")
    assert texts(pages(spark, [(1, "http://a.b/1", page), (2, "http://a.b/2", page)])) == {1: "A b c", 2: "A b c"}
    rows = [(k, "http://a.b/x", other if k == 5 else page) for k in range(6)]
    assert texts(pages(spark, rows))[0] == "A b c"


def test_copies_are_no_template(spark):
    page = "<body><nav>m</nav><article><h1>A</h1><p>b c</p><p>d e</p></article></body>"
    rows = [(k, f"http://c.d/{k}", page) for k in range(95)]
    rows += [(k, f"http://c.d/{k}", page.replace("b c", f"other {k}").replace("A", f"T{k}")) for k in range(95, 100)]
    found = texts(pages(spark, rows))
    assert [found[k] for k in range(95)] == ["A b c d e"] * 95
    assert [found[k] for k in range(95, 100)] == [f"T{k} other {k} d e" for k in range(95, 100)]


def test_only_the_template_node_is_left_out(spark):
    page = "<body><article><h1>{0}</h1><p>About {0}.</p>{1}<div><p>Sold by us.</p></div></article></body>"
    rows = [(k, f"http://e.f/{k}", page.format(f"thing{k}", "<p>Sold by us.</p>" if k == 7 else ""))
            for k in range(30)]
    found = texts(pages(spark, rows))
    assert found[7] == "thing7 About thing7. Sold by us." and found[8] == "thing8 About thing8."


def test_odd_pages(spark):
    page = "<body><article><p>ok</p></article></body>"
    rows = [(1, "http://a.b/1", page), (1, "http://a.b/1", page), (2, None, page), (None, "http://a.b", page),
            (3, "no url", None), (4, "http://a.b/4", ""), (5, "http://A.B:80/", "<p>" + "w " * 200_000)]
    found = extract_pages(pages(spark, rows)).collect()
    assert len(found) == len(rows)
    got = sorted((str(r.page_id), r.url or "", r.n_chars, len(r.text)) for r in found)
    assert all(n == m for *_, n, m in got)
    assert {r.text for r in found if str(r.page_id) in ("1", "2", "None")} == {"ok"}
    assert {r.n_chars for r in found if r.page_id in (3, 4)} == {0}
    assert {r.n_chars for r in found if r.page_id == 5} == {399_999}
    assert extract_pages(pages(spark, [])).count() == 0


def test_hosts():
    assert host_of("https://u:p@Www.X.org:8080/a?b#c") == "www.x.org"
    assert host_of(None) == host_of("nothing") == ""


def test_whole_table_against_the_article_element(spark):
    from stammwerk.llm.queries import op10_html_extraction

    found = op10_html_extraction(spark, SF_DIR).toPandas().set_index("page_id")
    for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        text = html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", article).replace("<b>", "").replace("</b>", ""))
        assert found.text[r.page_id] == " ".join(text.split())
        assert found.n_chars[r.page_id] == len(found.text[r.page_id])


ARTICLE = "<article><h1>T</h1><p>One two three.</p><p>Four.</p></article>"


@pytest.mark.parametrize("source, text", [
    (f"<form>{ARTICLE}</form>", "T One two three. Four."),
    (f"<div class='has-sidebar'>{ARTICLE}</div><nav>m</nav>", "T One two three. Four."),
    (f"<div id='page-header-wrap'>{ARTICLE}</div>", "T One two three. Four."),
    (f"<div class='social'>{ARTICLE}<div class='ad'>no</div></div>", "T One two three. Four."),
    (f"<div class='has-sidebar'><form>{ARTICLE}</form></div><footer>f</footer>", "T One two three. Four."),
    (f"{ARTICLE}<section id='comments'><article>a much longer comment than it</article></section>",
     "T One two three. Four."),
    ("<div class='comments'><article>nice</article></div><div>own text</div>", "own text"),
    ("<body><form><h1>T</h1><div>the text of it all</div></form></body>", "T the text of it all"),
    ("<div class='cookie'><p>We use some.</p><p>Yes.</p></div><p>x</p>", "x"),
    (f"<div hidden>{ARTICLE}</div><div role='form'>{ARTICLE}</div>", ""),
    ('<article><p title="a hidden gem">x</p><p data-x="display:none">y</p></article>', "x y"),
    ("<article><p aria-hidden='true'>n</p><p hidden>n</p><p style=display:none>n</p>y</article>", "y"),
    ('<p title="x>text</p><p>more', "text more"),
    ("<p title='it is'>text</p><p title=it's>more", "text more"),
    ("<![CDATA[ <p>x ]]>y<![CDATA[z>w", "yw"),
])
def test_names_and_attributes_do_not_hide_the_article(source, text):
    assert main_text(source, None, set()) == text


def test_two_content_containers_stay_whole():
    source = f"<body><div class='a'>{'w ' * 70}</div><div class='b'>{'v ' * 30}</div></body>"
    assert main_text(source, None, set()).split() == ["w"] * 70 + ["v"] * 30


@pytest.mark.parametrize("source", [
    "<a " * 350_000, "<a " * 350_000 + ">", "<a '>" * 200_001, "<! " * 300_000, "<![CDATA[>" * 100_000,
    "<div>" * 100_000 + "x", "<div>" * 100_000 + "x" + "</p>" * 100_000, "<span>" * 50_000 + "<li>" * 50_000,
    "<form>" * 100_000 + "x", "<p>x" * 100_000, "<div class='ad'>" * 50_000 + "<article>x",
], ids=lambda s: s[:12])
def test_a_megabyte_of_tags_takes_seconds(source):
    start = time.process_time()
    main_text(source, None, set())
    assert time.process_time() - start < 15  # under two on an idle core


def brute_force(body):
    """The text of a tree of (tag, children or text), without the parser."""
    if isinstance(body, str):
        return [body]
    return [t for child in body[1] for t in brute_force(child)]


@pytest.mark.parametrize("seed", range(5))
def test_own_pages_without_an_article_against_brute_force(spark, seed):
    """Pages of two hosts: a slot of random blocks, around it what is the same on all of them."""
    rng = random.Random(seed)

    def block(depth):
        if depth == 0 or rng.random() < 0.5:
            words = " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 9)))
            return (rng.choice(["p", "h2", "li", "blockquote"]), [words])
        return (rng.choice(["div", "section", "ul"]), [block(depth - 1) for _ in range(rng.randrange(1, 4))])

    def shown(body):
        return body if isinstance(body, str) else f"<{body[0]}>{''.join(map(shown, body[1]))}</{body[0]}>"

    rows, want = [], {}
    for i in range(60):
        body = ("div", [block(3) for _ in range(4)])
        frame = f"Frame of site {i % 2}"
        source = (f"<html><body><div class='top'><p>{frame}</p></div><nav>m</nav>{shown(body)}"
                  f"<div class='end'><p>{frame} ends</p></div></body></html>")
        rows.append((i, f"http://site{i % 2}.org/{i}", source))
        want[i] = " ".join(brute_force(body))
    assert texts(pages(spark, rows)) == want
