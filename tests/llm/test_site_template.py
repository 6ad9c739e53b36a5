"""Main text of pages: structure, broken markup, templates per host."""

import html
import re

import pytest
from pyspark.sql import functions as F

from labelwright.llm import site_template as S

PAGES = [
    ("", []),
    (None, []),
    ("plain &amp; simple\n text", ["plain & simple text"]),
    ("<p>One<br>two<p><b>Three<br><p>four", ["One two", "Three", "four"]),
    ("<script>var t='</p>';</script><p>a</p><style>p{}</style><p> b\n\tc&nbsp;d </p>", ["a", "b c d"]),
    ("<body><nav><ul><li>menu</ul></nav><article><h1>T</h1><p>x<p>y<div class='share bar'>tweet</div></article><p>after</p><footer>f</footer>", ["T", "x", "y"]),
    ("<main><header><h1>Title</h1></header><p>a</p><section id=comments><p>bad</p></section></main><div>out</div>", ["Title", "a"]),
    ("<header>site</header><div class=ad>buy</div><div class='advice'>keep</div>", ["keep"]),
    ("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>", ["one", "two", "in", "three"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("<p>a <!-- no > <p> --> b &lt;i&gt; <i>c</i>d</p>", ["a b <i> cd"]),
    ("<p title=\"x > y\">q</p><p title='unclosed>r</p>", ["q", "r"]),
    ("<article><p>body</p><article class=comment><p>reader</p></article></article>", ["body"]),
    ("<article>text <span class='ad'>buy</span>more</article>", ["text more"]),
    ("1 < 2 and 3 > 2 <", ["1 < 2 and 3 > 2 <"]),
    ("<p hidden>h</p><p style='display: none'>n</p><p>v</p>", ["v"]),
    ("<div>" * 5000 + "deep" + "</div>" * 5000, ["deep"]),
    ("</div></p>x</b>", ["x"]),
    ("<div id=content><p>Main body of some length</p></div><article><h3>Teaser</h3></article>", ["Main body of some length", "Teaser"]),
    ('<article><p class="notice">An important paragraph</p><p>x</p></article>', ["An important paragraph", "x"]),
    ('<article><div class="social sciences"><p>Social text</p></div></article>', ["Social text"]),
    ("<body><nav><a>m</a><article><p>body</p></article>", ["body"]),
    ("<aside><article><p>card</p></article></aside><article><p>body of the page</p></article>", ["body of the page"]),
    ("<div class='promo page'><p>nearly all of the page</p></div><div class=promo>buy</div>", ["nearly all of the page"]),
    ("<p>" + "long words " * 30_000 + "</p><aside>" + "x " * 50_000 + "</aside>", [("long words " * 30_000).strip()]),
]


@pytest.mark.parametrize("source, blocks", PAGES)
def test_blocks(source, blocks):
    assert S.remaining(S.parse(source), set())[0] == blocks


def test_templates_per_host(spark):
    page = lambda i, extra="": f"<body><div class=x><p>Follow us on every channel</p></div><p>story {i} of the day</p>{extra}</body>"
    rows = [(i, f"https://a.example/{i}", page(i)) for i in range(8)]
    rows += [(100 + i, f"https://b.example/{i}", page(i)) for i in range(3)]
    rows += [(200 + i, "http://c.example/x", "<body><p>one copied page</p></body>") for i in range(20)]
    rows += [(300 + i, f"http://u@d.example:80/{i}", f"<article><p>shared passage</p><div><p>boxed</p></div><p>own {i}</p></article>") for i in range(9)]
    rows += [(400, None, None), (401, "no url", ""), (401, "no url", ""), (None, None, "<p>x</p>")]
    pages = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, text string")
    got = S.main_text(pages).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert text[3] == "story 3 of the day"
    assert text[101] == "Follow us on every channel\nstory 1 of the day"
    assert text[207] == "one copied page"
    assert text[304] == "shared passage\nown 4"
    assert text[400] == text[401] == "" and text[None] == "x"
    assert all(r.n_chars == len(r.text) for r in got)
    assert S.main_text(pages.limit(0)).count() == 0


def brute_templates(pages):
    """Subtrees by host, counted over distinct contents with dictionaries."""
    seen = {}
    for url, source in pages:
        host = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+))?", url or "")[1] or ""
        page = S.parse(source)
        for h in page["hashes"]:
            if h:
                seen.setdefault((host.lower(), h), set()).add(page["content"])
    return {k for k, v in seen.items() if len(v) >= (S.MIN_TEXTS if k[1] % 2 else S.MIN_PAGES)}


def hosted():
    """Menus, adverts and notices that recur, under names and tags that say nothing."""
    menu = "<div class=x1><ul><li>Home</li><li>News</li></ul></div>"
    page = lambda i: f"<body>{menu}<div class=x2><p>Offer {i % 4} of the week</p></div><h2>Part</h2><p>words {i} of the page</p><p>All rights reserved</p></body>"
    rows = [(i, f"https://big.example/{i}", page(i)) for i in range(30)]
    return rows + [(100 + i, f"https://small.example/{i}", page(i)) for i in range(4)]


def test_templates_equal_brute_force(spark, sf_dir):
    made = spark.createDataFrame(hosted(), "page_id long, url string, html string")
    for pages in (made, spark.read.parquet(f"{sf_dir}/pages.parquet")):
        parsed = S._parsed(pages)
        got = {(r._h, r._t) for r in S.templates(parsed).collect()}
        assert got == brute_templates([(r.url, r.html) for r in pages.select("url", "html").collect()])
    rows = {r.page_id: r for r in S.main_text(made).collect()}
    # The menu, each offer and the notice recur; headings and the page's own words stay.
    assert rows[7].text == "Part\nwords 7 of the page" and rows[7].n_templates == 3 and rows[7].n_rules == 0
    assert rows[101].text.startswith("Home\nNews\nOffer 1") and rows[101].n_templates == 0


def test_recurrence_decides_on_given_pages(spark, sf_dir):
    """With the host as one, menus and adverts that recur are removed by their count."""
    pages = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/pages.parquet").withColumn("url", F.lit("http://one.example/"))
    found = S.main_text(pages).agg(F.sum("n_templates").alias("n"), F.count("*").alias("rows")).first()
    assert found.n > 0 and found.rows == pages.count()


def test_real_pages(spark, sf_dir):
    """Whole articles, and nothing else, of pages whose article is plainly marked."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in S.main_text(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)
