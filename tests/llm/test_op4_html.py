"""HTML extraction: marginals by brute force, whole pages against their marked article, edges."""

import html as entities
import re
import time
from itertools import product

from kerbline.llm import op4_html as op

FOLDER = "/root/testdata/sf0.01"


def brute_marginals(potentials, nodes):
    total, hit = 0.0, [0.0] * len(nodes)
    for labels in product((0, 1), repeat=len(nodes)):
        p = op.EVEN if labels[0] else 1 - op.EVEN
        for i, node in enumerate(nodes):
            if i:
                p *= potentials.child[labels[node.parent]][node.hint][labels[i]]
            for table, value in zip(potentials.seen, op.features(node), strict=True):
                p *= table[value][labels[i]]
        total += p
        for i, y in enumerate(labels):
            hit[i] += p * y
    return [h / total for h in hit]


def test_messages_give_exact_marginals():
    counts = {(0, 0, 0, 1): 5, (0, 1, 0, 0): 3, (1, 0, 0, 1): 40, (1, 2, 0, 0): 30, (2, 4, 0, 1): 9, (3, 3, 0, 0): 8}
    potentials = op.Potentials(counts)
    page = op.Page(
        "<body><div><p>one two three four<p>five <a>six</a></div><ul><li><a>x</a><li>y</ul>"
        "<div class=ad>buy</div><div><p>long text here of words</div></body>"
    )
    assert len(page.nodes) <= 12
    found = potentials.marginals(page.nodes)
    for a, b in zip(found, brute_marginals(potentials, page.nodes), strict=True):
        assert abs(a - b) < 1e-9


def marked(page):
    """The article of the synthetic pages, cut out by their own markup."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [entities.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(" ".join(b.split()) for b in blocks if b.split())


def test_query_equals_marked_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = op.query(spark, FOLDER).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.n_chars == len(r.text)
        if "<article>" in (pages[r.page_id] or ""):
            assert r.text == marked(pages[r.page_id]), r.page_id


def test_pages_without_marks_and_other_parts(spark):
    potentials = op.train(spark.read.parquet(f"{FOLDER}/pages.parquet"))
    words = "some words of a paragraph that goes on for quite a while and says a thing or two more."
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body><header><h2>Site</h2></header>
      <div id="cookie-notice"><p>We use {words}</p></div><div class="wrap"><h1>Head &amp; line</h1>
      <p>One {words}</p><p>Two&nbsp;{words}<br>more</p><form><p>Name {words}</p></form><p>Three {words}</p></div>
      <section class="comments"><p>First! {words}</p></section><aside><p>Also {words}</p></aside>
      <footer><p>&copy; me {words}</p></footer><script>var x = "<p>no</p>";</script></body></html>"""
    text = op.main_text(page, potentials)
    for wanted in ("One some", "Two some", "more.", "Three some"):
        assert wanted in text
    for other in ("Site", "We use", "Name", "First!", "Also", "©", "no", "T\n"):
        assert other not in text, other
    article = f"<article><h1>H</h1><p>A {words}<div class=comments><p>No {words}</p></div><p>B {words}</article>"
    assert op.main_text(f"<body>{article}</body>", potentials) == f"H\n\nA {words}\n\nB {words}"


def test_edges(spark):
    rows = [(1, "u", None, "x"), (2, "u", "", "x"), (3, None, "no tags at all", None), (3, None, "no tags at all", None),
            (None, "u", "<article><p>a\n b &lt;c&gt;</article>", "y"), (5, "u", "<p><b><div></p></i><article><p>x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    potentials = op.train(pages)
    found = op.extract(pages, potentials).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert texts[1] == texts[2] == "" and texts[None] == "a b <c>" and texts[5] == "x"
    empty = pages.filter("false")
    assert op.extract(empty, op.train(empty)).count() == 0
    began = time.time()
    for piece in ("<div>", "<p>", "<b>", "</div>", "<li>x", "&amp;", "<!-- ", "<a href='", "<ul><li>"):
        op.main_text("<article>" + piece * 5_000, potentials)
    op.main_text("<article>" + "<p>word word</p>" * 20_000, potentials)
    assert time.time() - began < 120


def test_wrappers_with_telling_names_keep_their_text(spark):
    potentials = op.train(spark.read.parquet(f"{FOLDER}/pages.parquet"))
    words = "some words of a paragraph that goes on for quite a while and says a thing or two more."
    text = "".join(f"<p>{k} {words}</p>" for k in ("One", "Two", "Three"))
    menu = "<nav><ul><li><a href=x>Home page</a><li><a href=y>All news</a></ul></nav>"
    side = f"<div class=sidebar><p>Beside {words}</p></div>"
    for page in (
        f"<body class='no-sidebar'>{menu}<div>{text}</div>{side}</body>",
        f"<body>{menu}<div class='site header-fixed'><div>{text}</div>{side}</div></body>",
        f"<body><div class='content-with-sidebar'>{menu}<div>{text}</div>{side}</div></body>",
        f"<body>{menu}<form id=aspnet><div>{text}</div>{side}</form></body>",
        f"<body class=no-sidebar><form><div class='site header-fixed'>{menu}<div>{text}</div>{side}</div></form></body>",
        "<body>" + menu + "".join(f"<div class=elementor-widget><p>{k} {words}</p></div>" for k in ("One", "Two", "Three")) + side + "</body>",
    ):
        found = op.main_text(page, potentials)
        assert found == "\n\n".join(f"{k} {words}" for k in ("One", "Two", "Three")), page


def test_sections_with_names_about_something_else_keep_their_text(spark):
    potentials = op.train(spark.read.parquet(f"{FOLDER}/pages.parquet"))
    words = "some words of a paragraph that goes on for quite a while and says a thing or two more."
    start = "<nav><a href=x>Home</a></nav><article>" + "".join(f"<p>{k} {words}</p>" for k in ("One", "Two", "Three"))
    for name in ("related-work", "notice-period", "form-of-government", "promo-code-guide", "search-engines", "plain-box"):
        text = op.main_text(f"<body>{start}<section class={name}><p>Four {words}</p></section></article></body>", potentials)
        assert text.split("\n\n") == [f"{k} {words}" for k in ("One", "Two", "Three", "Four")], name
    for name in ("comments", "comment-list", "site-footer", "related", "cookie-notice", "search-box"):
        text = op.main_text(f"<body>{start}<section class={name}><p>Four {words}</p></section></article></body>", potentials)
        assert "Four" not in text, name


def test_all_marks_train(spark):
    pages = [("<ARTICLE\nid=a><p>a b",), ("<main><p>a b",), ("<div role=main><p>x",), ("<div role = 'main'><p>x",), ("<articles><p>x",), (None,)]
    marked = spark.createDataFrame(pages, "html string").filter(op.MARKED)
    assert marked.count() == 4
