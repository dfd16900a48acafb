"""Articles inside forms and under names that only look like furniture; furniture that stays furniture; linear time."""

import time

import pytest

from sousflow.llm import op4_html_text

TREE = op4_html_text.train()
LONG = "The committee met on Tuesday to talk about the harbour wall and the money that is needed for it, and it agreed on most points."
MORE = "A second meeting follows in the spring, when the engineers have measured how far the wall has moved since the last storm."


def text(page):
    return op4_html_text.main_texts([page], TREE)[0]


@pytest.mark.parametrize("page", [
    f"<form id='aspnetForm'><main><h1>Harbour wall</h1><p>{LONG}</p><p>{MORE}</p></main></form>",
    f"<main><section id='search-algorithms'><h1>Harbour wall</h1><p>{LONG}</p><p>{MORE}</p></section></main>",
    f"<article><h1>Harbour wall</h1><p class='lead social-impact'>{LONG}</p><p>{MORE}</p></article>",
])
def test_probe_pages(page):
    assert text(page) == f"Harbour wall\n{LONG}\n{MORE}"


FORMS = ["<form>{}</form>", "<form id='form1' method='post'>{}</form>", "<form class='search-page'>{}</form>", "<div class='header'>{}</div>", "<div id='footer-top'>{}</div>",
         "<fieldset>{}</fieldset>", "<div class='sidebar'>{}</div>", "<form><div class='wrapper'>{}</div></form>"]
NAMES = ["legal-history", "comment-culture", "ad-astra", "share-prices", "social-contract", "login-design", "search-and-rescue", "review-notice-boards", "popular-science",
         "cookie-recipes", "menu-planning", "footer-theory", "promo-psychology"]


@pytest.mark.parametrize("form", FORMS)
def test_article_inside_wrappers(form):
    for inner in ("<article><h1>Harbour wall</h1><p>{}</p><p>{}</p></article>", "<main><h1>Harbour wall</h1><p>{}</p><p>{}</p></main>"):
        page = f"<html><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>{form.format(inner.format(LONG, MORE))}<footer><p>&copy; The paper</p></footer></body></html>"
        assert text(page) == f"Harbour wall\n{LONG}\n{MORE}", form


@pytest.mark.parametrize("name", NAMES)
def test_names_that_only_hint(name):
    for page in (f"<article><h1>Harbour wall</h1><section class='{name}'><p>{LONG}</p><p>{MORE}</p></section></article>", f"<article><h1>Harbour wall</h1><p id='{name}'>{LONG}</p><p>{MORE}</p></article>"):
        assert text(page) == f"Harbour wall\n{LONG}\n{MORE}", name


@pytest.mark.parametrize("side", [
    "<div class='related-posts'><h3>More</h3><ul><li><a href='/1'>One thing</a></li><li><a href='/2'>Another thing</a></li></ul></div>", "<div class='cookie-banner'><p>We use cookies to make this site better for you and for others.</p></div>",
    "<aside><article><p>A short teaser of another story.</p></article></aside>", "<div class='social-share-links'><a href='/f'>Share</a></div>",
    "<div class='comment-list'><p>I do not agree with any of this, as the wall is older than the town.</p></div>", "<form class='newsletter-signup'><p>Get the news by mail each morning.</p></form>"])
def test_furniture_stays_furniture(side):
    assert text(f"<html><body><article><h1>Harbour wall</h1><p>{LONG}</p><p>{MORE}</p></article>{side}</body></html>") == f"Harbour wall\n{LONG}\n{MORE}"


def test_unmatched_end_tags_take_linear_time():
    page = "<article><p>" + "<span>" * 100_000 + "</b>" * 100_000 + "Some words of the text stand here.</p></article>"
    start = time.perf_counter()
    assert text(page) == "Some words of the text stand here."
    assert time.perf_counter() - start < 5
    deep = "<div class='nav'>" * 30_000 + "word " * 3 + "</div>" * 30_000
    op4_html_text.blocks(deep)
