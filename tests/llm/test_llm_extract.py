"""Pages that lost their article: wrappers with marks in their names, custom and self-closed elements, optional end tags."""

import pytest

from cohortlens.llm import extract

ART = "<p>" + "The first paragraph of the article. " * 8 + "</p><p>" + "The second one. " * 12 + "</p>"
WANT = ["The first paragraph of the article. " * 8, "The second one. " * 12]


@pytest.mark.parametrize("page, head", [
    (f"<div class='content no-sidebar'><h1 class='post-header'>Title</h1>{ART}</div>", ["Title"]),
    (f"<div class='layout has-sidebar'>{ART}<div class='sidebar'>Links</div><div class=site-footer>Foot</div></div>", []),
    (f"<div class='overlay'><div class='widget'>{ART}</div><div class='ad'>Buy</div></div>", []),
    (f"<div>{ART}</div><div class='comments'>{'<p>Well said. </p>' * 90}</div>", []),
    (f"<div><svg-icon name=a><svg viewBox='0 0 1 1' /><button-group><object-x>{ART}</div>", []),
    (f"<div><svg><text>drawn</text></svg>{ART}</div>", []),
    (f"<div><p class='notice'>Read this{ART}</div>", []),
    (f"<div><ul><li class='share'>Share<li>One item of the list</ul>{ART}</div>", ["One item of the list"]),
    (f"<div>{ART[: ART.index('</p>') + 4]}<div class='ad'>Buy</div>{ART[ART.index('</p>') + 4 :]}</div>", []),
    (f"<div><section><div class='ad'>Buy</section>{ART}</div>", []),
    (f"<div><p>Intro <nav><p>x</p> y</nav>{ART}</div>", ["Intro"]),
])
def test_article_stays(page, head):
    page = f"<html><body>{page}</body></html>"
    path, _ = extract.best_path(extract.read_blocks(page))
    assert extract.main_text(page, path).split("\n") == [*head, *(x.strip() for x in WANT)]


LONG = "a sentence of the article that says something at length, and goes on. " * 4
SHAPES = {
    "title and lead before sections": ("<body><div class=top>Site</div><article><h1>Title</h1><p>Lead of it<section><p>{0}</section><section><p>{0}</section></article>",
                                       ["Title", "Lead of it", LONG, LONG]),
    "lead beside a body": ("<body><div class=wrap><div class=content><h1>Title</h1><p>Lead of it<div class=body><p>{0}<p>{0}</div></div></div>", ["Title", "Lead of it", LONG, LONG]),
    "a table in the article": ("<article><p>Before<table><tr><td>{0}<td>{0}</table><p>After</article>", ["Before", LONG, LONG, "After"]),
    "intro and rest": ("<article><div class=intro>Intro</div><div class=rest><p>{0}</p></div></article>", ["Intro", LONG]),
    "a caption and a formula": ("<article><figure><img src=x><figcaption>What it shows</figcaption></figure><p>{0}<p>with <math><mi>x</mi></math> in it</article>",
                                ["What it shows", LONG, "with x in it"]),
    "an article in main": ("<main><div class=crumbs>Home</div><article><h2>Head</h2><p>{0}</article></main>", ["Head", LONG]),
    "a title in main": ("<main><h1>Head</h1><article><p>{0}</article></main>", ["Head", LONG]),
    "a teaser article beside the text": ("<body><div class=x><article><p>Teaser</article></div><div class=y><p>{0}<p>{0}</div>", [LONG, LONG]),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_nothing_of_the_article_is_lost(spark, shape):
    page, want = SHAPES[shape]
    page = page.format(LONG)
    df = spark.createDataFrame([(1, "http://h.org/1", page)], "page_id long, url string, html string")
    assert extract.extract(df).first()["text"].split("\n") == [" ".join(x.split()) for x in want]


def test_equal_votes_go_to_the_longer_text_then_path(spark):
    """Two pages, two paths: the one with more text wins the host, and of equal ones the greater path."""
    page = "<body><div class='{}'><p>{}</p></div>"
    rows = [(1, "http://h.org/1", page.format("a", LONG)), (2, "http://h.org/2", page.format("b", LONG * 2)),
            (3, "http://k.org/1", page.format("a", LONG)), (4, "http://k.org/2", page.format("b", LONG))]
    got = {r["page_id"]: r["text"] for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == got[3] == got[4] == LONG.strip() and got[2] == (LONG * 2).strip()
