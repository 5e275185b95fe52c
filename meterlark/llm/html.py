"""Main text of web pages, by containers on whose paths the pages of a host agree.

Every page scores its containers by the text that stands in them outside of links. From the best
one the vote is passed up: to an outer container that holds further free text, which would be lost
otherwise, unless that container spans the page and holds little more. What it ends at is the page's
vote for its generalised path: tags with their classes, digits replaced. Votes are added up per host by
Spark, and the paths with a fair share of a host's votes win; of winning paths inside one another
one is left. Each page is then extracted again from the elements on winning paths; a page without any
(or without text in them) falls back on the container that it has voted for itself. A main heading
that stands before and outside of the winning elements, in a container around them, is kept if they have none.

Menus, headers of the site, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are known by their tags, roles and class names, and left out wherever they stand. Names
that articles have too (UNSURE) do not count for paragraphs of an article, nor for an element with
most of the page's free text.

A null page counts as empty, and an empty page, or one without main text, has an empty text. Pages
whose URL is null or has no host vote together. A page of any length is read whole. Rows that
repeat vote and are extracted each. Tags that are never closed, or closed without being open, do
not matter. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlark.llm.common import small_batches, texts_of
from meterlark.session import materialize

#: Share of a host's votes from which a path wins, besides the path with most votes.
FAIR_SHARE = 0.2
#: Share of the free text of a container that spans the page, from which text beside the best container counts as the article's.
PAGE_SHARE = 0.2
#: The same share for paragraphs beside a table cell.
CELL_SHARE = 0.1
#: Containers inside so many others have no path of their own: their text counts for the one that holds them.
DEEPEST = 100
#: Winning paths up to this number are broadcast, more are joined by a shuffle.
BROADCAST_PATHS = 200_000

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg"}
#: Elements that never hold main text.
LEFT_OUT = set("nav footer aside form button select menu dialog head".split()) | RAW
CONTAINERS = set("article main section div td body blockquote".split())
BLOCKS = CONTAINERS | set(
    "address dd details dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li nav ol p pre summary table tbody tfoot thead th tr ul aside menu".split()
)
#: A start of one of these ends an open one of the same group below the nearest list, table or container.
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LEVELS = set("ul ol dl table div article main section body select".split())
#: Class, id or role words of parts that are not main text.
BAD_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices banner alert menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar aside widget widgets footer masthead toolbar comment comments commentlist reply replies respond discussion disqus share "
    "sharing social related recommended newsletter subscribe subscription signup login popup modal overlay paywall pagination pager skip hidden complementary contentinfo search".split()
)
TAG = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>")
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Words that may stand beside a bad one in the name of the part itself: ad-box, cookie-notice, site-footer.
PART_WORDS = set("box bar area block container wrapper wrap section list form panel inner outer main site page global top bottom left right primary secondary links buttons item items text message unit slot title".split())
#: Bad words that also name parts with main text.
UNSURE = set("alert discussion search widget widgets masthead overlay modal respond social share sharing toolbar hidden complementary menu".split())
#: Words of names of containers that span the page.
SPANNING = set("page site wrap wrapper container layout outer inner main app root blog home top row document".split())
#: Words of article or main elements that are not the page's own.
OTHER_ARTICLES = {"comment", "comments", "reply", "related", "sponsored", "ad", "promo"}
NAME = re.compile(r"[a-z]+")


def _names_part(name: str, bad: set[str]) -> bool:
    """Whether a whole class, id or role names a part that is not main text: of bad words and PART_WORDS alone."""
    words = NAME.findall(name)
    if not words or bad.isdisjoint(words):
        return False
    return all(w in bad or w in PART_WORDS for w in words)


class Element:
    """An open element: its tag, path, whether it is left out, and the container that its text counts for."""

    __slots__ = ("above", "box", "by_name", "container", "depth", "heading", "left_out", "path", "semantic", "spanning", "tag", "unsure")

    def __init__(self, tag: str, path: str, left_out: bool, container: str, semantic: bool, parent: Element | None = None, by_name: bool = False, spanning: bool = False, unsure: int = -1) -> None:
        self.tag, self.path, self.left_out, self.container, self.semantic = tag, path, left_out, container, semantic
        #: Left out only for names that do not hold for an article or main below.
        self.by_name = by_name
        #: Start in the page of the element that is left out for an unsure name alone, -1 if there is none.
        self.unsure = unsure
        #: For containers: whether it spans the page.
        self.spanning = spanning
        #: The innermost container, and the one around it.
        self.box = self if parent is None or path != parent.path else parent.box
        self.above = None if parent is None else parent.box if self.box is self else parent.above
        self.depth = 0 if parent is None else parent.depth + (self.box is self)
        self.heading = tag == "h1" or (parent is not None and parent.heading)


ROOT = Element("", "", False, "", False, spanning=True)


def _spans_page(tag: str, tokens: list[str]) -> bool:
    if tag != "div":
        return tag == "body"
    return not tokens or any((words := NAME.findall(t)) and all(w in SPANNING for w in words) for t in tokens)


def _opened(tag: str, attributes: str, parent: Element, start: int, spared: bool) -> Element:
    classes, bad, named, unsure, tokens = "", False, False, False, []
    if attributes:
        names = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
        classes = "".join("." + re.sub(r"\d+", "0", c) for c in sorted(names.get("class", "").lower().split()))
        tokens = f"{names.get('class', '')} {names.get('id', '')} {names.get('role', '')}".lower().split()
        if tag not in ("html", "body"):
            of = OTHER_ARTICLES if tag in ("article", "main") else BAD_WORDS
            parts = [t for t in tokens if _names_part(t, of)]
            bad = any(not OTHER_ARTICLES.isdisjoint(NAME.findall(t)) for t in parts)
            named = bool(parts) and not bad
            unsure = named and all(w in UNSURE or w not in BAD_WORDS for t in parts for w in NAME.findall(t))
            if unsure and (spared or (tag == "p" and parent.semantic)):
                named = False
        bad = bad or names.get("aria-hidden") == "true" or "hidden" in names
    # A header inside a container of its own name is the article's, not the site's.
    site_header = tag == "header" and not parent.semantic and (parent.box.spanning or parent.box.tag not in ("div", "section"))
    hard = bad or tag in LEFT_OUT or site_header or (parent.left_out and not parent.by_name)
    inherited = parent.by_name and tag not in ("article", "main")
    left_out = hard or named or inherited
    contains = tag in CONTAINERS and parent.depth < DEEPEST
    path = f"{parent.path}>{tag}{classes}" if contains else parent.path
    semantic = parent.semantic or tag in ("article", "main")
    container = parent.container if parent.semantic or not contains else path
    since = -1
    if not hard and (unsure or not named) and left_out:
        since = parent.unsure if inherited else start
    return Element(tag, path, left_out, container, semantic, parent, (named or inherited) and not hard, _spans_page(tag, tokens), since)


def blocks(page: str, unsure: Counter | None = None, spared: int = -1) -> Iterator[tuple[Element, str, int]]:
    """(innermost element, text, characters of it inside links) of each block of a page, in order.

    Text that is left out for an unsure name alone is counted in `unsure`, per start of the element
    and whether it stands in an article; the element that starts at `spared` keeps its text.
    """
    stack, texts, linked, in_link = [ROOT], [], 0, 0
    at, end = 0, len(page)

    def flush():
        nonlocal texts, linked
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            if text:
                found.append((owner, text, linked))
            texts, linked = [], 0

    found: list[tuple[Element, str, int]] = []
    owner = ROOT
    while at < end:
        m = TAG.search(page, at)
        piece = page[at : m.start() if m else end]
        if piece and not stack[-1].left_out:
            if not texts:
                owner = stack[-1]
            texts.append(piece)
            if in_link:
                linked += len(piece)
        elif unsure is not None and piece and not in_link and stack[-1].unsure >= 0:
            unsure[stack[-1].unsure, stack[-1].semantic] += len("".join(piece.split()))
        if m is None:
            break
        at = m.end()
        if m[0] == "<!--":
            close = page.find("-->", at)
            at = end if close < 0 else close + 3
            continue
        name = m[2] or m[5]
        if name is None:
            continue
        tag, closing = name.lower(), bool(m[1] or m[4])
        attributes = m[3] if m[2] else m[6]
        if closing:
            if tag == "a":
                in_link = max(0, in_link - 1)
            if tag in BLOCKS or tag in LEFT_OUT:
                flush()
                yield from found
                found.clear()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    if stack[k].left_out != stack[k - 1].left_out:
                        flush()
                    del stack[k:]
                    break
            continue
        if tag == "br":
            if texts:
                texts.append(" ")
            continue
        if tag in RAW:
            if not attributes.endswith("/") or tag in ("script", "style", "textarea", "title"):
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
                at = end if close is None else (page.find(">", close.end()) + 1 or end)
            continue
        if tag in BLOCKS:
            flush()
            yield from found
            found.clear()
            for k in range(len(stack) - 1, 0, -1):
                open_tag = stack[k].tag
                if open_tag == "p" or open_tag in SAME_LEVEL.get(tag, ()):
                    del stack[k:]
                    break
                if open_tag in LEVELS:
                    break
        if tag in VOID or attributes.endswith("/"):
            continue
        if tag == "a":
            in_link += 1
            if "class" not in attributes and "role" not in attributes:
                continue
        if tag in BLOCKS or tag in LEFT_OUT or attributes:
            element = _opened(tag, attributes, stack[-1], m.start(), m.start() == spared)
            if element.left_out and not stack[-1].left_out:
                flush()
            stack.append(element)
    flush()
    yield from found


def kept_blocks(page: str) -> list[tuple[Element, str, int]]:
    """The blocks of a page, also of an element of unsure name that holds most of the page's free text."""
    unsure: Counter = Counter()
    found = list(blocks(page, unsure))
    if unsure:
        (start, in_article), most = min(unsure.items(), key=lambda s: (-s[1], s[0]))
        others = sum(len("".join(text.split())) for owner, text, linked in found if linked < len(text)) + sum(unsure.values()) - most
        if most > others and (in_article or not any(owner.semantic for owner, _, _ in found)):
            return list(blocks(page, None, start))
    return found


def _free(text: str, linked: int) -> int:
    return len(text) - min(linked, len(text))


def containers(found: list[tuple[Element, str, int]]) -> Counter:
    """Score of each container by its own text, by its generalised path."""
    scores: Counter = Counter()
    for owner, text, linked in found:
        free = _free(text, linked)
        if free > 0:
            scores[owner.container] += free * (1.5 if len(text) > 80 else 1) * free / len(text) * (2 if owner.semantic else 1)
    return scores


def _passed_up(best: str, found: list[tuple[Element, str, int]]) -> tuple[str, bool]:
    """The path that the vote for `best` is passed up to, and whether its container spans the page.

    It goes to an outer container with more free text if that is not mostly links. A container that
    spans the page needs PAGE_SHARE of its text to stand beside. A quotation passes up to paragraphs
    around it in any case; for a table cell, which may be a column of the page, only they count.
    """
    inside, length, direct, boxes, around = Counter(), Counter(), Counter(), {}, []
    for owner, text, linked in found:
        free, box, seen, outer = _free(text, linked), owner.box, set(), []
        direct[owner.path] += free
        while box is not None:
            if box.path not in seen:
                seen.add(box.path)
                inside[box.path] += free
                length[box.path] += len(text)
                if box.path not in boxes or box.spanning:
                    boxes[box.path] = box
                outer.append(box.path)
            box = box.above
        if best in seen and not around:
            around = outer[outer.index(best) + 1 :]
    at = best
    for path in around:
        more, box = inside[path] - inside[at], boxes[path]
        if more <= 0:
            continue
        tag = boxes[at].tag
        if tag == "blockquote" and direct[path] > 0:
            at = path
            continue
        if tag == "td":
            more = direct[path]
            enough = more >= (PAGE_SHARE if box.spanning else CELL_SHARE) * inside[path]
        elif box.spanning:
            enough = more >= PAGE_SHARE * inside[path]
        else:
            enough = 2 * more >= length[path] - length[at]
        if not enough:
            break
        at = path
    return at, at in boxes and boxes[at].spanning


def best_container(page: str) -> tuple[str, bool] | None:
    """(path, whether it spans the page) of the container that the page votes for.

    Of equally good containers the shortest path goes first, then the first by name. An article or
    main element is taken as it is.
    """
    found = kept_blocks(page)
    scores = containers(found)
    if not scores:
        return None
    best = min(scores, key=lambda p: (-scores[p], len(p), p))
    if any(owner.semantic and owner.container == best for owner, _, _ in found):
        return best, False
    return _passed_up(best, found)


def vote(page: str) -> str | None:
    """The path that a page votes for."""
    best = best_container(page)
    return None if best is None else best[0]


def extract(page: str, paths: set[str]) -> str:
    """The blocks inside containers on one of the paths, joined by empty lines, after the main heading if that stands outside."""
    texts, title, has_title = [], [], False
    for owner, text, _ in kept_blocks(page):
        if any(owner.path == p or owner.path.startswith(p + ">") for p in paths):
            texts.append(text)
            has_title = has_title or owner.heading
        elif owner.heading and not texts and any(p.startswith(owner.path + ">") for p in paths):
            title = [text]
    return "\n\n".join(([] if has_title or not texts else title) + texts)


def host(url: str = "url") -> F.Column:
    """The host of a URL, in lower case, without user and port; empty if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def winning_paths(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, paths) by the votes of all pages of a host."""

    def run(batches):
        for batch in small_batches(batches, 256, 1):
            best = [best_container(p) or (None, None) for p in texts_of(batch.column(1))]
            voted = [pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *voted], ["host", "path", "spanning"])

    votes = pages.select(host(url).alias("host"), page).mapInArrow(run, "host string, path string, spanning boolean").where("path is not null")
    # Written once: both the totals and the paths read it, and pages are parsed for it.
    counts = materialize(votes.groupBy("host", "path").agg(F.count("*").alias("n"), F.bool_or("spanning").alias("spanning")), "votes")
    # At most 1 / FAIR_SHARE paths and the best one are left of a host.
    totals = counts.groupBy("host").agg(F.sum("n").alias("all"), F.min(F.struct(-F.col("n"), F.length("path"), "path")).alias("best"))
    fair = counts.join(totals, "host").where(f"n >= {FAIR_SHARE} * all or path = best.path")
    fair = fair.groupBy("host").agg(F.collect_list(F.struct("path", "n", "spanning")).alias("fair"), F.min("best.path").alias("best"))
    # Of paths inside one another the outer one stays, but one that spans the page only if it has as many votes.
    within = lambda p, q: F.startswith(p["path"], F.concat(q["path"], F.lit(">")))
    beaten = lambda p, q: (within(p, q) & (~q["spanning"] | (q["n"] >= p["n"]))) | (within(q, p) & p["spanning"] & (q["n"] > p["n"]))
    left = F.filter("fair", lambda p: ~F.exists("fair", lambda q: beaten(p, q)))
    paths = F.array_sort(F.transform(left, lambda p: p["path"]))
    return fair.select("host", F.when(F.size(paths) > 0, paths).otherwise(F.array("best")).alias("paths"))


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page; runs a job for the votes."""
    winners = materialize(winning_paths(pages, url, page), "paths")
    few = winners.count() <= BROADCAST_PATHS
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("url"), F.col(page).alias("_page"), host(url).alias("host"))
    rows = rows.join(F.broadcast(winners) if few else winners, "host", "left").select("_key", "url", "_page", "paths")

    def run(batches):
        for batch in small_batches(batches, 256, 2):
            out = []
            for text, paths in zip(texts_of(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                found = extract(text, set(paths)) if paths else ""
                if not found and (own := vote(text)) is not None:
                    found = extract(text, {own})
                out.append(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], [key, "url", "text", "n_chars"])

    kind = pages.select(key).schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, url string, text string, n_chars long")
