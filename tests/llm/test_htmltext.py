"""Main text of pages: hand-made pages, edge cases and the given pages."""

import html
import re

import pytest

from starmart.llm import htmltext
from starmart.llm.queries import op7_html_text

BODY = "First sentence of the story, with commas, and more. Second sentence follows here. "
PAGES = {
    "article with everything around it": (
        f"""<html><head><title>T</title><style>p{{}}</style></head><body>
        <header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
        <div class="cookie-notice">We use cookies, really. Accept them all, please.</div>
        <article><header><h1>Head &amp; line</h1></header><p>{BODY}<p>Next &eacute;&#32;<b>bold</b>
        text.</p><aside>Related stuff, to read. More.</aside><script>if (a<b) "</p>"</script>
        <ul><li>A listed item, too.</li></ul></article>
        <section id="comments"><article><p>Reader says: {BODY}</p></article></section>
        <form><p>Sign up now, it is free. Really, it is.</p></form><footer>&copy; Site. All rights.</footer></body></html>""",
        f"Head & line\n{BODY.strip()}\nNext é bold text.\nA listed item, too.",
    ),
    "no main element": (
        f"""<body><div><a href=1>Home</a> <a href=2>News</a></div><div><p>{BODY}</p><p>{BODY * 3}</p></div>
        <div><a href=3>Imprint</a></div>""",
        f"{BODY.strip()}\n{(BODY * 3).strip()}",
    ),
    "named wrapper around the main element": (
        f'<body><div class="content-with-sidebar"><main><p>{BODY}</p></main></div>',
        BODY.strip(),
    ),
    "class words of the main element": (f"<body><main class='with-sidebar'><p>{BODY}</p></main>", BODY.strip()),
    "class words of an article": (f"<article class='post category-social'><p>{BODY}</p></article>", BODY.strip()),
    "class of a page without main element": (f"<div id='page' class='has-sidebar'><p>{BODY}</p></div>", BODY.strip()),
    "named wrapper of most text": (
        f"<div class='sidebar-left'><p>{BODY}</p></div><div class='site-footer'>A footer, here.</div>", BODY.strip()
    ),
    "form round the page": (f"<body><form action=x><div><p>{BODY}</p></div></form></body>", BODY.strip()),
    "form round an article": (f"<form><article><p>{BODY}</p></article><nav>Menu, here.</nav></form>", BODY.strip()),
    "all furniture": (f"<aside><p>{BODY}</p></aside>", BODY.strip()),
    **{
        f"{name} between long paragraphs": (
            f"{start}{f'<p>{BODY * 6}</p>' * 6}{middle}{f'<p>{BODY * 6}</p>' * 6}{end}",
            "\n".join([(BODY * 6).strip()] * 6 + lines + [(BODY * 6).strip()] * 6),
        )
        for start, end in (("<article>", "</article>"), ("<body><div>", "</div>"), ("<body>", "</body>"))
        for name, middle, lines in (
            (f"list in {start}", "<ul>" + "<li>an item" * 10 + "</ul>", ["an item"] * 10),
            (f"links in {start}", "<ul>" + "<li><a href=x>a link</a>" * 9 + "</ul>", ["a link"] * 9),
            (f"table in {start}", "<table><tr><td>a<td>b</table>", ["a", "b"]),
        )
    },
    "cut inside a tag": (f"<article><p>{BODY}</p><p cla", BODY.strip()),
    "cut inside a script": (f"<article><p>{BODY}</p><script>var x", BODY.strip()),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    page, text = PAGES[name]
    assert htmltext.main_text(page) == text


def test_edges(spark):
    pages = [None, "", "<p></p>", "plain, text.", "<" * 5000, "<div>" * 5000 + "deep, text.", '<a "' * 5000,
             "<p>" + "long, text. " * 50_000, "a < b, c > d.", "<!-- open", "</p></x>&bogus; ok, then."]
    frame = spark.createDataFrame([(i, p, 1) for i, p in enumerate(pages)], "page_id long, html string, text int")
    rows = htmltext.extract(frame).orderBy("page_id").collect()
    assert [r.text for r in rows[:4]] == ["", "", "", "plain, text."]
    assert rows[5].text == "deep, text." and rows[7].n_chars == 600_000 - 1
    assert all(r.n_chars == len(r.text) for r in rows)
    assert rows[8].text == "a < b, c > d." and rows[10].text == "&bogus; ok, then."
    assert htmltext.extract(frame.limit(0)).collect() == []


NAMES = (
    "user-comments article-comments comment-thread fb-comments ad-slot js-ad cookie-law-info related-articles "
    "author-bio entry-footer global-nav commentList post-sidebar"
).split()


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("around", ["article", "div"])
def test_named_furniture_goes_wherever_its_word_stands(name, around):
    body = "".join(f"<p>Sentence number {i}, with a clause, and some more words in it.</p>" for i in range(5))
    page = f'<body><{around}>{body}<div class="{name}"><p>Aside words, which do not belong here at all.</p></div>{body}</{around}></body>'
    text = htmltext.main_text(page)
    assert "Aside" not in text and text.count("Sentence") == 10


@pytest.mark.parametrize("name", ["with-sidebar", "has-comments", "no-ads", "commentary", "navy", "adapted", "related-work", "biology"])
def test_other_names_stay(name):
    body = "".join(f"<p>Sentence number {i}, with a clause, and some more words in it.</p>" for i in range(5))
    page = f'<body><article>{body}<div class="{name}"><p>Inner words, which do belong here.</p><ul><li><a href="/x">One</a></li><li>Two</li></ul></div></article></body>'
    text = htmltext.main_text(page)
    assert text.split("\n")[-3:] == ["Inner words, which do belong here.", "One", "Two"]


def test_query(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in op7_html_text(spark, sf_dir).collect():
        page = pages.pop(r.page_id)
        inner = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inner)
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        assert r.text.split("\n") == [x for x in lines if x]
        assert r.url == page.url
    assert not pages
