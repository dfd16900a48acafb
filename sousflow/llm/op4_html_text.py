"""Main text of web pages: flat text blocks classified by a decision tree.

A page is read once from left to right into flat blocks: the text between block-level tags,
with the number of its words, the share of them inside links, and the enclosing containers
that are open. Each block is classified from its own figures and those of the blocks before
and after it, by a decision tree trained on a small labelled table, which is built here by
rule from a fixed seed.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, text_of
from .trees import Tree, classify

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?--!?>|.*\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>(?:[^>"']|"[^"<]*"|'[^'<]*')*))>"""
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden|aria-label)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)

#: Elements whose content is never text of the page.
DROPPED = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "audio", "video", "canvas", "title", "select", "option", "datalist", "button", "map")
#: Of these, those whose content is no markup: without an end tag they take the rest of the page.
RAW = frozenset(("script", "style", "textarea", "title", "iframe"))
#: Of the others, those that a further one of their kind closes.
_ONCE = frozenset(("button", "select", "option", "datalist"))
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
#: Tags that end a block; all others run on inside one.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Kinds of container, by tag or by a word of class, id or role.
CONTAINERS = ("nav", "header", "footer", "aside", "form", "notice", "advert", "comments", "article", "hidden", "head")
_BY_TAG = {"nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "fieldset": "form", "dialog": "notice", "article": "article", "main": "article", "head": "head"}
_BY_WORD = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs skip skiplink sitemap toolbar",
    "header": "header masthead banner topbar site-header logo branding",
    "footer": "footer copyright colophon legal contentinfo bottom",
    "aside": "sidebar aside related recommended widget rail complementary trending popular latest newsletter share sharing social tags readmore promo-box more-stories",
    "form": "form search login signup signin subscribe subscription register",
    "notice": "cookie cookies consent gdpr notice alert modal popup overlay dialog paywall announcement disclaimer toast",
    "advert": "ad ads advert adverts advertisement advertising sponsored sponsor promo promotion banner-ad adsense dfp outbrain taboola",
    "comments": "comment comments commentlist respond replies reply disqus discussion feedback reviews",
    "article": "article post story entry article-body post-body post-content entry-content article-content main-content maincontent content-body story-body main content",
}
_WORDS = {word: kind for kind, words in _BY_WORD.items() for word in words.split()}
#: Parts of a class or id that say nothing of the kind: with them a compound such as "site-footer-wrap" is still a mark.
_GENERIC = frozenset(
    "a area b bar block body bottom box btn button buttons card col column columns container content desktop entry feed fixed global grid group heading hero holder icon icons inline "
    "inner item items js large layout left link links list main mobile module new outer page pane panel primary region right row section secondary shell show site slot small sticky "
    "text theme title top ui unit view widget wide wp wrap wrapper your my the".split())
_FIGURES = ("words", "link_density", "chars_per_word", "ends_sentence", "capitals", "heading", "list_item", "cell")
FEATURES = (*_FIGURES, *(f"in_{c}" for c in CONTAINERS), "page_has_article",
            *(f"before_{f}" for f in _FIGURES[:2]), *(f"after_{f}" for f in _FIGURES[:2]), "place", "copyright")


def _containers(tag: str, attrs: str) -> tuple[set[str], set[str]]:
    """The kinds of container that a tag opens, and those that only a part of a longer name hints at ("search-algorithms")."""
    found, hints = ({_BY_TAG[tag]} if tag in _BY_TAG else set()), set()
    if "=" in attrs or "hidden" in attrs.lower():
        for name, value in _ATTRIBUTE.findall(attrs):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                found.add("hidden")
            elif name in ("class", "id", "role", "aria-label"):
                for word in value.split():
                    if word in _WORDS:
                        found.add(_WORDS[word])
                    else:
                        parts = re.split(r"[-_]+", word)
                        kinds = [_WORDS[part] for part in parts if part in _WORDS]
                        side = [k for k in kinds if k != "article"]
                        sure = all(part in _WORDS or part in _GENERIC or part.isdigit() for part in parts)
                        (found if sure or not side else hints).update(side or kinds)
    # page furniture inside an article's own wrapper keeps its kind; the body of the page is no article
    return (found, hints - found) if tag not in ("html", "body") else (found - set(_BY_WORD), set())


def _body_of(tag: str, page: str, start: int) -> int:
    end = _ENDS[tag].search(page, start)
    return end.end() if end else len(page)


def _ends_of_dropped(page: str) -> dict[int, int]:
    """Where the content of each dropped element that is not raw ends, by the end of its start tag; none for one without an end tag in its block."""
    found: dict[int, int] = {}
    open_: list[tuple[str, int]] = []
    count: Counter[str] = Counter()
    at = 0
    while m := _TOKEN.search(page, at):
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if tag not in BLOCK_TAGS and tag not in DROPPED:
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if m["close"] or m["close2"]:
            while count[tag]:
                name, start = open_.pop()
                count[name] -= 1
                if name == tag:
                    if tag in DROPPED:
                        found[start] = at
                    break
        elif tag in RAW:
            at = _body_of(tag, page, at)
        elif tag not in VOID_TAGS and not attrs.endswith("/"):
            if tag in _ONCE and open_ and open_[-1][0] == tag:
                _, start = open_.pop()
                count[tag] -= 1
                if tag == "option":  # the next one ends it
                    found[start] = m.start()
            open_.append((tag, at))
            count[tag] += 1
    return found


#: Kinds that no element can be that holds most of the page's words and the article or its title.
_FURNITURE = frozenset(("nav", "header", "footer", "aside", "form", "notice", "advert", "comments"))
#: A block of so many words, or with half of them in links, looks like furniture.
_SHORT, _LINKED = 6, 0.5


@dataclass
class _Container:
    """An element of a kind: the blocks from ``start`` to ``end``."""

    kind: str
    hint: bool
    tag: str
    start: int
    end: int = -1


def _inside(held: list[_Container], rows: np.ndarray, titles: np.ndarray) -> np.ndarray:
    """For each block and kind, whether the block lies in a container of the kind.

    What holds most of the page's words (outside links) together with an article, main or h1 element is no furniture, nor
    is a form that holds most of them; a hint counts for the blocks that look like furniture themselves.
    """
    n = len(rows)
    words = np.concatenate([[0.0], np.cumsum(rows[:, 0] * (1 - rows[:, 1]))])
    cores = np.zeros(n + 1)
    cores[:n] += titles
    for c in held:
        cores[c.start] += c.tag in ("article", "main")
    cores = np.concatenate([[0.0], np.cumsum(cores)])
    sure, hinted = np.zeros((n + 1, len(CONTAINERS))), np.zeros((n + 1, len(CONTAINERS)))
    for c in held:
        most = 2 * (words[c.end] - words[c.start]) > words[-1]
        if c.kind in _FURNITURE and most and (c.tag == "form" or cores[c.end] > cores[c.start]):
            continue
        k = CONTAINERS.index(c.kind)
        (hinted if c.hint else sure)[c.start, k] += 1
        (hinted if c.hint else sure)[c.end, k] -= 1
    looks = (rows[:, 0] <= _SHORT) | (rows[:, 1] >= _LINKED)
    return (np.cumsum(sure, axis=0)[:n] > 0) | (np.cumsum(hinted, axis=0)[:n] > 0) & looks[:, None]


def blocks(page: str) -> list[tuple[str, list[float]]]:
    """Text and figures of every non-empty flat block, in page order."""
    found: list[tuple[str, list[float]]] = []
    open_tags: list[tuple[str, list[_Container]]] = []
    count: Counter[str] = Counter()  # of the open tags
    held: list[_Container] = []
    titles: list[bool] = []
    parts: list[str] = []
    linked, has_article = 0, False
    mark = {"heading": 0.0, "list_item": 0.0, "cell": 0.0}
    title = False

    def flush() -> None:
        nonlocal linked, parts
        text = " ".join("".join(parts).split())
        if text:
            n = text.count(" ") + 1
            found.append((text, [
                n, min(1.0, linked / n), (len(text) - n + 1) / n, float(text[-1] in ".!?…:;\"'”»)"), sum(c.isupper() for c in text) / len(text),
                mark["heading"], mark["list_item"], mark["cell"]]))
            titles.append(title)
        parts, linked = [], 0

    def close() -> str:
        tag, containers = open_tags.pop()
        count[tag] -= 1
        for c in containers:
            c.end = len(found)
        return tag

    at, links = 0, 0
    ends: dict[int, int] | None = None
    while at < len(page):
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            text = html.unescape(text)
            parts.append(text)
            linked += len(text.split()) if links else 0
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if m["close"] or m["close2"]:
            if tag in BLOCK_TAGS:
                flush()
            while count[tag]:  # an end tag without a start tag closes nothing
                name = close()
                links -= name == "a"
                if name == tag:
                    break
        elif tag in DROPPED:
            if tag == "button":
                parts.append(" ")
            if tag in RAW:
                at = _body_of(tag, page, at)
            elif not attrs.endswith("/"):
                ends = _ends_of_dropped(page) if ends is None else ends
                at = ends.get(at, at)
        else:
            if tag in BLOCK_TAGS:
                flush()
                if tag in ("p", "li") or tag[0] == "h" and tag[1:].isdigit():  # these end an open paragraph
                    while open_tags and open_tags[-1][0] in ("p", "b", "i", "em", "strong", "span", "font", *(("li",) if tag == "li" else ())):
                        close()
                mark["heading"], mark["list_item"], mark["cell"] = float(tag in ("h1", "h2", "h3", "h4", "h5", "h6")), float(tag in ("li", "dt", "dd")), float(tag in ("td", "th"))
                title = tag == "h1"
            elif tag == "br":
                parts.append(" ")
            if tag not in VOID_TAGS and not attrs.endswith("/"):
                kinds, hints = _containers(tag, attrs) if tag in BLOCK_TAGS or "=" in attrs or "hidden" in attrs else ((), ())
                containers = [_Container(kind, kind in hints, tag, len(found)) for kind in (*kinds, *hints)]
                open_tags.append((tag, containers))
                count[tag] += 1
                links += tag == "a"
                held += containers
                has_article = has_article or "article" in kinds
    flush()
    while open_tags:
        close()
    if found:
        inside = _inside(held, np.array([row for _, row in found]), np.array(titles, dtype=float))
        for (_, row), kinds in zip(found, inside.astype(float).tolist(), strict=True):
            row += [*kinds, float(has_article)]
    return found


def features(page: list[tuple[str, list[float]]]) -> np.ndarray:
    """One row per block: its figures, its neighbours' words and link density, its place, a copyright mark."""
    if not page:
        return np.zeros((0, len(FEATURES)))
    own = np.array([row for _, row in page])
    edge = np.array([[0.0, 1.0]])
    place = np.arange(len(page))[:, None] / len(page)
    rights = np.array([[float("©" in text or "(c)" in text.lower() or "all rights" in text.lower())] for text, _ in page])
    return np.hstack([own, np.vstack([edge, own[:-1, :2]]), np.vstack([own[1:, :2], edge]), place, rights])


def labelled_pages(seed: int = 4, count: int = 400) -> list[tuple[str, list[str]]]:
    """Small pages built by rule, each with the blocks that are its main text."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    serial = iter(range(10**9))
    chance = lambda p: rng.random() < p

    def sentence(n: int) -> str:
        words = ["".join(pick("abcdefghilmnoprstu") for _ in range(int(rng.integers(1, 10)))) for _ in range(n)]
        words[-1] += "".join("qxyzjkwv"[int(d)] for d in f"{next(serial):o}")  # no two sentences are equal
        return " ".join(words).capitalize() + pick([".", ".", ".", "", "!"])

    def links(n: int) -> str:
        return "".join(f"<li><a href='/x'>{sentence(int(rng.integers(1, 5))).rstrip('.!')}</a></li>" for _ in range(n))

    out = []
    for _ in range(count):
        main: list[str] = []

        def keep(text: str, tag: str = "p", into: list[str] = main) -> str:
            into.append(text)
            return f"<{tag}>{text}</{tag}>"

        def linked_paragraph(into: list[str] = main) -> str:
            a, b, c = sentence(int(rng.integers(4, 20))), sentence(int(rng.integers(1, 4))), sentence(int(rng.integers(3, 12)))
            into.append(f"{a} {b} {c}")
            return f"<p>{a} <a href='/y'>{b}</a> <em>{c}</em></p>"

        body = [keep(sentence(int(rng.integers(1, 12))), pick(["h1", "h1", "h2"]))] if chance(0.8) else []
        for _ in range(int(rng.integers(1, 9))):
            kind = rng.random()
            if kind < 0.62:
                body.append(keep(sentence(int(rng.choice([1, 2, 3, 6, 12, 30, 60])))))
            elif kind < 0.72:
                body.append(linked_paragraph())
            elif kind < 0.79:
                body.append("<ul>" + "".join(keep(sentence(int(rng.integers(1, 10))), "li") for _ in range(3)) + "</ul>")
            elif kind < 0.86:
                body.append(keep(sentence(int(rng.integers(1, 7))), pick(["h2", "h3"])))
            elif kind < 0.91:
                body.append("<blockquote>" + keep(sentence(int(rng.integers(8, 25)))) + "</blockquote>")
            elif kind < 0.95:
                body.append("<table><tr>" + "".join(keep(sentence(int(rng.integers(1, 4))), "td") for _ in range(3)) + "</tr></table>")
            else:
                body.append(pick(["<div class='ad'>{}</div>", "<aside>{}</aside>", "<div class='related'><p>{}</p></div>", "<div class='share'>{}</div>", "<form><p>{}</p></form>"]).format(sentence(int(rng.integers(2, 20)))))
        menu = pick(["<nav><ul>{}</ul></nav>", "<div class='menu'><ul>{}</ul></div>", "<ul>{}</ul>", "<nav><ul>{}</ul></nav>", "<div id='nav'><ul>{}</ul></div>"]).format(links(int(rng.integers(3, 8))))
        top = pick(["<header>{}</header>", "<div class='site-header'>{}</div>", "{}"]).format((f"<p>{sentence(3)}</p>" if chance(0.3) else "") + menu) if chance(0.9) else ""
        if top.startswith("<ul>") is False and not top.startswith(("<header", "<div", "<nav")) and top:
            top = f"<header>{top}</header>"
        notice = pick(["<div class='cookie-notice'><p>{}</p></div>", "<div id='consent'>{}</div>", "<dialog><p>{}</p></dialog>", "<div class='alert'>{}</div>"]).format(sentence(int(rng.integers(4, 30)))) if chance(0.4) else ""
        advert = pick(["<div class='ad'>{}</div>", "<div class='advertisement'><p>{}</p></div>", "<div class='sponsored'><p>{}</p></div>"]).format(sentence(int(rng.integers(2, 40)))) if chance(0.6) else ""
        side = pick(["<aside><p>{}</p><ul>{}</ul></aside>", "<div class='sidebar'><p>{}</p><ul>{}</ul></div>", "<div class='related'><h3>{}</h3><ul>{}</ul></div>"]).format(sentence(int(rng.integers(2, 25))), links(4)) if chance(0.5) else ""
        form = pick(["<form><p>{}</p><label>Mail</label></form>", "<div class='newsletter'><p>{}</p></div>", "<form class='search'><label>{}</label></form>"]).format(sentence(int(rng.integers(2, 15)))) if chance(0.4) else ""
        comments = pick(["<section id='comments'><h3>Comments</h3>{}</section>", "<div class='comments'>{}</div>", "<ol class='commentlist'>{}</ol>"]).format("".join(f"<div class='comment'><p>{sentence(int(rng.integers(3, 40)))}</p></div>" for _ in range(2))) if chance(0.45) else ""
        foot = pick(["<footer>{}</footer>", "<div class='footer'><p>{}</p></div>", "<footer><p>{}</p></footer>"]).format(pick(["&copy; ", "All rights reserved. ", ""]) + sentence(int(rng.integers(3, 20)))) if chance(0.9) else ""
        wrap = pick(["<article>{}</article>", "<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "<main><article>{}</article></main>", "<div>{}</div>", "{}"])
        inside = chance(0.3)  # furniture inside the article's own element
        article = wrap.format("".join(body) + (comments + side if inside else ""))
        if chance(0.25):  # a bare page
            top, notice, advert, side, form, foot = (x if chance(0.2) else "" for x in (top, notice, advert, side, form, foot))
            comments = "" if inside else comments
        page = f"<html><head><title>t</title></head><body>{top}{notice}{advert}{article}{'' if inside else side}{form}{'' if inside else comments}{foot}</body></html>"
        out.append((page, main))
    return out


def train(seed: int = 4) -> Tree:
    """The decision tree; the same for every run."""
    xs, ys = [], []
    for page, main in labelled_pages(seed):
        found, wanted = blocks(page), {" ".join(html.unescape(t).split()) for t in main}
        xs.append(features(found))
        ys.append(np.array([text in wanted for text, _ in found], dtype=float))
    return classify(np.vstack(xs), np.concatenate(ys), depth=14, least=2)


def main_texts(pages: list[str], tree: Tree) -> list[str]:
    """The main text of each page: its accepted blocks in page order, one per line."""
    found = [blocks(page) for page in pages]
    if not any(found):
        return [""] * len(pages)
    good = tree.predict(np.vstack([features(x) for x in found])) >= 0.5
    out, at = [], 0
    for x in found:
        out.append("\n".join(text for (text, _), ok in zip(x, good[at : at + len(x)], strict=True) if ok))
        at += len(x)
    return out


def extract_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    A null or empty page, and one without main text, gives an empty text. Ids and urls are
    passed through, null or repeated; broken or cut-off markup is read as far as it goes.
    """
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                texts = main_texts(batch.column("html").to_pylist(), tree)
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    rows = pages.select(pages[id_column].cast("long").alias("page_id"), pages[url_column].cast("string").alias("url"), text_of(pages, html_column).alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
