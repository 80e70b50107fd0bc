"""Whole articles: nested sections, wrappers, unclosed boilerplate, comments, names."""

import pytest

from inspecta.llm import html_extract

W, M = "word " * 300, "more " * 100
LONG, MORE = W.strip(), M.strip()

PAGES = {
    "nested sections": (f"<article><h1>T</h1><section class=intro><p>{W}</p></section><section class=more><p>{M}</p></section></article>", f"T\n{LONG}\n{MORE}"),
    "divs with a title": (f"<div class=page><h1>T</h1><div class=a><p>{W}</p></div><div class=b><p>{M}</p></div></div>", f"T\n{LONG}\n{MORE}"),
    "form around the page": (f"<form id=aspnetForm><div><nav><a href=x>menu</a></nav><article><h1>T</h1><p>{W}</p></article></div></form>", f"T\n{LONG}"),
    "unclosed menu": (f"<nav><ul><li><a href=x>menu</a></ul><article><h1>T</h1><p>{W}</p></article>", f"T\n{LONG}"),
    "header around the title": (f"<article><div class='article-header'><h1>T</h1></div><p>{W}</p></article>", f"T\n{LONG}"),
    "longer comments": (f"<article><p>{M}</p></article><section id=comments><h2>Said</h2><p>{W}</p></section>", MORE),
    "comments in the article": (f"<article><p>{W}</p><div class='post-comments'><p>{M}</p></div></article>", LONG),
    "names that only begin like boilerplate": (f"<article><p class='share-price'>Up.</p><p>{W}</p><p class=ad-hoc-note>Note.</p></article>", f"Up.\n{LONG}\nNote."),
    "names of boilerplate": (f"<article><p>{W}</p><p class='share-buttons'>Tell.</p><p class=ad-slot>Buy.</p><div id=cookie_banner>Yes.</div></article>", LONG),
    "first paragraph is a link": ("<article><p><a href=x>" + "lead " * 20 + "</a></p><p>Short end.</p></article><div class=z>" + "blurb " * 30 + "</div>",
                                  ("lead " * 20).strip() + "\nShort end."),
    "main with a title": (f"<main><h1>T</h1><article><p>{W}</p></article></main><div>{M}</div>", f"T\n{LONG}"),
    "several articles": (f"<div class=list><article><p>{M}</p></article><article><p>{W}</p></article></div><div class=x>{'x ' * 9}</div>", f"{MORE}\n{LONG}"),
    "article within an article": (f"<article><p>{W}</p><article><p>{M}</p></article></article>", f"{LONG}\n{MORE}"),
    "side text without a name": (f"<div class=left><p>{W}</p></div><div class=right><p>Little.</p></div>", LONG),
    "hidden copy": (f"<article><p>{W}</p><div style='display: none'><h1>T</h1>{W}</div></article>", LONG),
    "only boilerplate": (f"<nav>{M}</nav><footer>{W}</footer>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    body, want = PAGES[name]
    assert html_extract.main_text(f"<html><body>{body}</body></html>", None) == want


def test_hosts_vote_for_whole_articles(spark):
    body, want = PAGES["nested sections"]
    rows = [(i, f"http://a.example/{i}", f"<html><body>{body}</body></html>") for i in range(20)]
    rows += [(20 + i, "http://b.example/", f"<html><body>{b}</body></html>") for i, (b, _) in enumerate(PAGES.values())]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(20)] == [want] * 20
    assert len(got) == len(rows)
