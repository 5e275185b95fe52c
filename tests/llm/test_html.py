import random

import pytest

from meterlark.llm import html

LONG = "This sentence is long enough to look like the text of an article, and so it goes on for quite a while. " * 3
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1><p>{LONG}</p></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>comment</p> -->
<div class="ad">Buy now</div><div id="cookie-notice"><p>{LONG}</p></div><div class="wrap"><div class="post-123 main-text"><h1>Title &amp; more</h1>
<p><b>First<br>  block &lt;x&gt;&nbsp;&#8364;</p><p>Second <i>block</i> {LONG}<p>Third <a href="x">link</a><form><p>form</p></form><ul><li>one<li>two</ul>
<table><tr><td>a<td>b</table><aside>{LONG}</aside></div></div><section class="comments"><p>{LONG}</p></section><footer>foot</footer></body></html>"""
TEXT = "\n\n".join(["Title & more", "First block <x> €", f"Second block {LONG.strip()}", "Third link", "one", "two", "a", "b"])


def pages(spark, rows):
    return spark.createDataFrame([(k, u, h, "clash") for k, u, h in rows], "page_id long, url string, html string, host string")


def test_vote_and_extraction():
    assert html.vote(PAGE) == ">body>div.wrap>div.main-text.post-0"
    assert html.extract(PAGE, {html.vote(PAGE)}) == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain text", "plain text"),
        ("<p>a</p>b<p>c", "a\n\nb\n\nc"),
        ("<body><article><p>open <b>tag<p>next</article>", "open tag\n\nnext"),
        ("<article>a<script>x</article>", "a"),
        ("<article>a &amp;amp; <!-- never closed <p>b</p>", "a &amp;"),
        ("<article><header><h2>Kept</h2></header><p>x</p><div class='comment'>no</div></article>", "Kept\n\nx"),
        ('<article><p title="a>b">x</p><img alt="unclosed><p>y</p></article>', "x\n\ny"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<article><p>a</p><div hidden>no</div><span class='ad-box'>no</span>z</article>", "a\n\nz"),
    ],
)
def test_odd_markup(page, text):
    assert html.extract(page, {html.vote(page)} if html.vote(page) is not None else set()) == text


def test_pages_of_a_host_agree(spark):
    """A page whose longest container is another one is extracted from the host's path."""
    usual = f"<body><div class='text'><p>Body {LONG}</p></div><div class='box'><p>Short</p></div></body>"
    odd = f"<body><div class='text'><p>Brief body</p></div><div class='box'><p>{LONG * 3}</p></div></body>"
    rows = [(k, f"https://user@Host.example:80/{k}", usual) for k in range(9)] + [(9, "http://host.example/x?y", odd), (10, "http://other.example/", odd)]
    got = {r.page_id: r for r in html.main_texts(pages(spark, rows)).collect()}
    assert {r.text for k, r in got.items() if k < 9} == {f"Body {LONG.strip()}"}
    assert got[9].text == "Brief body" and got[10].text == (LONG * 3).strip()
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_odd_rows(spark):
    rows = [(1, None, PAGE), (1, None, PAGE), (None, "no host", None), (2, "http://h/", ""), (3, "http://h/", "<nav>only menu</nav>"), (4, "http://h/", "<p>x</p>" * 20000)]
    got = sorted(((r.page_id, r.text[:10], r.n_chars) for r in html.main_texts(pages(spark, rows)).collect()), key=repr)
    assert got == [(1, "Title & mo", len(TEXT)), (1, "Title & mo", len(TEXT)), (2, "", 0), (3, "", 0), (4, "x\n\nx\n\nx\n\nx", 59998), (None, "", 0)]


def test_large_tables_of_paths_are_joined(spark, monkeypatch):
    monkeypatch.setattr(html, "BROADCAST_PATHS", 0)
    assert [r.text for r in html.main_texts(pages(spark, [(1, "http://h/", PAGE)])).collect()] == [TEXT]


def test_empty_table(spark):
    assert html.main_texts(pages(spark, [])).count() == 0


@pytest.mark.parametrize("wrapper", ["class='content no-sidebar'", "id='page-with-widget'", "class='post has-comments'", "class='sidebar-wrapper'", "data-title='The hidden costs of'", "title='a hidden gem'"])
def test_wrappers_that_only_mention_a_part_are_kept(wrapper):
    page = f"<body><div {wrapper}><article><p>{LONG}</p><figure><figcaption>Caption</figcaption></figure></article></div></body>"
    assert html.extract(page, {html.vote(page)}) == LONG.strip() + "\n\nCaption"


@pytest.mark.parametrize("part", ["class='site-footer'", "class='x ad-box'", "id=cookie-notice", "hidden=''", "HIDDEN", "role='navigation'"])
def test_named_parts_are_left_out(part):
    page = f"<body><p>{LONG}</p><div {part}><p>{LONG}</p></div></body>"
    assert html.extract(page, {html.vote(page)}) == LONG.strip()


LEAD = "A shorter lead that opens the text."
PART = LONG[:150].strip()


@pytest.mark.parametrize(
    ("body", "text"),
    [
        (f"<nav>x</nav><div class=post><div class=lead><p>{LEAD}</p></div><div class=text><p>{LONG}</p></div></div>", [LEAD, LONG.strip()]),
        (f"<h1>Title</h1><div class=body><p>{LONG}</p></div><h1>Below</h1>", ["Title", LONG.strip()]),
        (f"<div class=post><h1>Title</h1><div class=body><p>{LONG}</p></div></div>", ["Title", LONG.strip()]),
        (f"<section class=a><p>{LONG}</p></section><section class=b><p>{PART}</p></section>", [LONG.strip(), PART]),
        (f"<div class=post><p>{LEAD}</p><blockquote><p>{LONG}</p></blockquote><p>{LEAD}</p></div>", [LEAD, LONG.strip(), LEAD]),
        (f"<p>{LEAD}</p><blockquote>{LONG}</blockquote><p>{LEAD}</p>", [LEAD, LONG.strip(), LEAD]),
        (f"<div class=post><p>{LEAD}</p><table><tr><td>{LONG}</td></tr></table><p>{LEAD}</p></div>", [LEAD, LONG.strip(), LEAD]),
        (f"<table><tr><td class=left><p>{LEAD}</p></td><td class=text><p>{LONG}</p></td></tr></table>", [LONG.strip()]),
        (f"<div class=post><header><h1>Title</h1></header><p>{LONG}</p></div>", ["Title", LONG.strip()]),
        (f"<div id=page><header><h1>Site</h1></header><p>{LONG}</p></div>", [LONG.strip()]),
        (f"<article><p>{LONG}</p><p class=alert>{LEAD}</p><div class=alert>no</div></article>", [LONG.strip(), LEAD]),
        (f"<div class=discussion><p>{LONG}</p></div>", [LONG.strip()]),
        (f"<section class=search><p>{LONG}</p></section><p>x</p>", [LONG.strip()]),
        (f"<article><p>{LEAD}</p></article><div class=alert><p>{LONG}</p></div>", [LEAD]),
        (f"<p>{LEAD}</p><div class=cookie-notice><p>{LONG}</p></div>", [LEAD]),
        (f"<div class=text><p>{LONG}</p></div><div class=more><p>{LEAD}</p></div>", [LONG.strip()]),
        (f"<div class=post><div class=text><p>{LONG}</p></div><div class=more><a href=x>{LONG}</a> and so on</div></div>", [LONG.strip()]),
    ],
)
def test_whole_articles(body, text):
    page = f"<html><body>{body}<footer>foot</footer></body></html>"
    assert html.extract(page, {html.vote(page)}) == "\n\n".join(text)


def test_two_templates_of_a_host(spark):
    """The outer of two winning paths stays if it is the article's own; one that spans the page only with as many votes."""
    plain = f"<body><div class=post><div class=text><p>{LONG}</p></div></div></body>"
    led = f"<body><div class=post><div class=lead><p>{LEAD}</p></div><div class=text><p>{LONG}</p></div></div></body>"
    beside = f"<body><div class=text><p>{LONG}</p></div><div class=more><p>{LONG[:-50]}</p></div></body>"
    alone = f"<body><div class=text><p>{LONG}</p></div><div class=more><p>{LEAD}</p></div></body>"
    other = f"<body><section class=s1><p>{LONG}</p></section></body>"
    rows = [(k, "http://a/", led if k % 3 == 0 else plain) for k in range(9)] + [(k, "http://b/", beside if k % 3 == 0 else alone) for k in range(10, 19)]
    rows += [(k, "http://c/", plain if k % 2 else other) for k in range(20, 24)]
    paths = {r.host: r.paths for r in html.winning_paths(pages(spark, rows)).collect()}
    assert paths == {"a": [">body>div.post"], "b": [">body>div.text"], "c": [">body>div.post>div.text", ">body>section.s0"]}
    got = {r.page_id: r.text for r in html.main_texts(pages(spark, rows)).collect()}
    assert got[0] == f"{LEAD}\n\n{LONG.strip()}" and {got[k] for k in (1, 10, 11, 20, 21)} == {LONG.strip()}


def random_tree(rnd, depth=0):
    """(tag, class, children); children are trees and (text, whether it is a link)."""
    children = []
    for _ in range(rnd.randint(1, 4)):
        if depth < 4 and rnd.random() < 0.55:
            tag = rnd.choice(["div", "div", "div", "section", "blockquote"])
            children.append((tag, rnd.choice(["text", "lead", "wrap", "box", "c1", "c2", ""]) if tag == "div" else "", random_tree(rnd, depth + 1)))
        else:
            children.append((("word " * rnd.choice([1, 3, 10, 18, 40])).strip(), rnd.random() < 0.2))
    return children


def rendered(children):
    out = []
    for child in children:
        if len(child) == 2:
            out.append(f"<p><a href=x>{child[0]}</a></p>" if child[1] else f"<p>{child[0]}</p>")
        else:
            tag, name, below = child
            out.append(f"<{tag} class='{name}'>{rendered(below)}</{tag}>" if name else f"<{tag}>{rendered(below)}</{tag}>")
    return "".join(out)


def all_boxes(children, path=">body", tag="body", spans=True):
    """(path, tag, whether it spans the page, children) of every container of a tree."""
    yield path, tag, spans, children
    for child in children:
        if len(child) == 3:
            below = f"{path}>{child[0]}" + (f".{child[1]}".replace("1", "0").replace("2", "0") if child[1] else "")
            yield from all_boxes(child[2], below, child[0], child[0] == "div" and child[1] in ("", "wrap"))


def texts_in(children):
    for child in children:
        if len(child) == 2:
            yield child
        else:
            yield from texts_in(child[2])


def expected_vote(children):
    """The vote by an explicit tree: sums are taken anew for every path from all of its boxes."""
    boxes = list(all_boxes(children))

    def own(path):
        return [c for p, _, _, below in boxes if p == path for c in below if len(c) == 2]

    def free_inside(path):
        # A path is never inside an equal one, so no text is counted twice.
        return sum(len(t) for p, _, _, below in boxes if p == path for t, link in texts_in(below) if not link)

    def all_inside(path):
        return sum(len(t) for p, _, _, below in boxes if p == path for t, _ in texts_in(below))

    scores = {p: sum(len(t) * (1.5 if len(t) > 80 else 1) for t, link in own(p) if not link) for p, *_ in boxes}
    if not any(scores.values()):
        return None
    at = min((p for p in scores if scores[p]), key=lambda p: (-scores[p], len(p), p))
    ancestors = [at[:k] for k in range(len(at) - 1, 0, -1) if at[k] == ">"]
    for path in ancestors:
        more = free_inside(path) - free_inside(at)
        spans = any(s for p, _, s, _ in boxes if p == path)
        if more == 0:
            continue
        if at.rsplit(">", 1)[1] == "blockquote" and any(not link for _, link in own(path)):
            at = path
        elif spans and more < 0.2 * free_inside(path):
            break
        elif not spans and 2 * more < all_inside(path) - all_inside(at):
            break
        else:
            at = path
    return at


def test_votes_equal_an_explicit_tree():
    rnd = random.Random(7)
    passed_up = 0
    for _ in range(400):
        tree = random_tree(rnd)
        page = f"<html><body>{rendered(tree)}</body></html>"
        want = expected_vote(tree)
        assert html.vote(page) == want, page
        if want is not None:
            inside = [t for p, _, _, below in all_boxes(tree) if p == want for t, _ in texts_in(below)]
            assert html.extract(page, {want}) == "\n\n".join(inside)
            passed_up += len(inside) > 1
    assert passed_up > 100


def test_query_equals_brute_force(spark):
    """Votes, winning paths and texts of whole pages against lists and loops."""
    rnd = random.Random(3)
    kinds = [random_tree(rnd) for _ in range(7)]
    rows = [(k, f"http://h{rnd.randint(0, 3)}/", rnd.choice(kinds)) for k in range(60)]
    votes = {}
    for _, url, tree in rows:
        if (path := expected_vote(tree)) is not None:
            found = votes.setdefault(url, {})
            n, _ = found.get(path, (0, False))
            found[path] = (n + 1, any(s for p, _, s, _ in all_boxes(tree) if p == path) or found.get(path, (0, False))[1])
    want = {}
    for k, url, tree in rows:
        found = votes.get(url, {})
        top = min(found, key=lambda p: (-found[p][0], len(p), p))
        fair = [p for p in found if p == top or found[p][0] >= 0.2 * sum(n for n, _ in found.values())]
        out = {p for p in fair for q in fair if p.startswith(q + ">") and (not found[q][1] or found[q][0] >= found[p][0])}
        out |= {p for p in fair for q in fair if q.startswith(p + ">") and found[p][1] and found[q][0] > found[p][0]}
        left = [p for p in fair if p not in out] or [top]
        chosen = _texts_on(tree, left)
        want[k] = "\n\n".join(chosen or _texts_on(tree, [expected_vote(tree)]))
    got = {r.page_id: r.text for r in html.main_texts(pages(spark, [(k, u, f"<body>{rendered(t)}</body>") for k, u, t in rows])).collect()}
    assert got == want


def _texts_on(children, paths, path=">body", inside=False):
    inside = inside or path in paths
    out = []
    for child in children:
        if len(child) == 2:
            out += [child[0]] if inside else []
        else:
            below = f"{path}>{child[0]}" + (f".{child[1]}".replace("1", "0").replace("2", "0") if child[1] else "")
            out += _texts_on(child[2], paths, below, inside)
    return out


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + f"<p>{LONG}</p>" + "</div>" * 3000
    assert html.extract(deep, {html.vote(deep)}) == LONG.strip()
