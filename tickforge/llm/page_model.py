"""A tree-structured graphical model of which parts of a page are its main text.

Nodes are a page's block elements and its runs of text; a hidden label says content or not.
Potentials on edges tie each node's label to its parent's, by the node's kind; potentials on
nodes tie labels to what is seen there: tag, words in class, id and role, and length, link
share and punctuation of a run.  All are smoothed counts over labelled pages.  Sum-product
messages go from the leaves up and from the root down and give each node's marginal.

Labelled pages are built here (`labelled_pages`): pages of many layouts, with articles,
menus, headers, footers, sidebars, notices, adverts, forms and comments in the markup that
sites use, whose content is known as they are made.  Other labelled pages can be given:
data-main="1" or "0" on an element labels it and what is in it.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

#: Elements whose inside isn't markup; each goes with it, to the page's end where no end tag follows.
RAW = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "template", "textarea", "iframe", "title")}
#: Elements that are passed over whole where their end tag follows; without one, what comes after is read on.
SKIPPED = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("noscript", "select", "svg")}
AFTER_NAME, SPECIAL = re.compile(r"[\s/>]"), re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+))|([^\s=\"'/]+)")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var button canvas object".split())
MATH = frozenset("math annotation maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
INLINE |= MATH
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Opening one of these closes an open one of the others, up to the stop.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
GROUPS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs toolbar",
    "head": "header masthead banner topbar site-header logo branding",
    "foot": "footer copyright colophon legal bottom",
    "side": "sidebar aside related widget recommended rail teaser more links complementary",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted adsense",
    "notice": "cookie cookies consent notice gdpr popup modal overlay newsletter subscribe alert paywall banner",
    "reply": "comment comments disqus reply replies respond discussion reviews",
    "share": "share social sharing follow",
    "meta": "byline author date meta tags timestamp caption",
    "main": "content article post entry story main body text maincontent articlebody page",
}
_GROUP_OF = {w: g for g, words in GROUPS.items() for w in words.split()}
_WORDS = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
KNOWN_TAGS = frozenset("html body nav header footer aside article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th form fieldset figure figcaption blockquote pre details".split())


@dataclass(slots=True)
class Node:
    parent: int
    kind: str
    seen: tuple[str, ...]
    text: str | None = None
    label: int | None = None


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)


def _attributes(raw: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)} if raw.strip(" /") else {}


def _element(tag: str, attributes: dict[str, str]) -> tuple[str, tuple[str, ...]]:
    seen = ["tag:" + (tag if tag in KNOWN_TAGS else "other")]
    names = " ".join(attributes.get(k, "") for k in ("class", "id", "role", "aria-label")).lower()
    if names.strip():
        groups = {_GROUP_OF[w] for w in _WORDS.findall(names) if w in _GROUP_OF}
        seen += [f"name:{g}" for g in sorted(groups)] or ["name:other"]
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or HIDDEN.search(attributes.get("style", "")):
        seen.append("hidden")
    return (tag if tag in KNOWN_TAGS else "other"), tuple(seen)


def _run(text: str, links: int, parent: str) -> tuple[str, tuple[str, ...]]:
    n = len(text)
    length = "0" if n < 12 else "1" if n < 40 else "2" if n < 100 else "3" if n < 250 else "4"
    share = links / max(1, n)
    linked = "all" if share > 0.8 else "some" if share > 0.3 else "few" if links else "none"
    stop = "stop" if text[-1:] in ".!?…:;\"”»" else "open"
    return "run", (f"length:{length}", f"links:{linked}", f"end:{stop}", f"in:{parent}", *(("sign",) if "©" in text else ()))


class Ahead:
    """The next match of a pattern from any place on; the stretch up to it is looked at once."""

    def __init__(self, page: str, pattern: re.Pattern):
        self.page, self.pattern, self.start, self.found = page, pattern, 0, -1

    def __call__(self, at: int) -> int:
        if not self.start <= at <= self.found:
            m = self.pattern.search(self.page, at)
            self.start, self.found = at, m.start() if m else len(self.page)
        return self.found


class Tags:
    """Where the tags of a page end.  No stretch is looked at again and again, however the page is broken."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.name_end, self.special = Ahead(page, AFTER_NAME), Ahead(page, SPECIAL)
        self.endless: set[int] = set()  # special characters outside quotes from which no tag's end is reached

    def end(self, at: int) -> int:
        """Behind the first > from `at` on that isn't quoted; -1 if there is none."""
        passed: list[int] = []
        while at <= self.last:
            k = self.special(at)
            if k >= len(self.page) or k in self.endless:
                break
            if self.page[k] == ">":
                return k + 1
            passed.append(k)
            close = self.page.find(self.page[k], k + 1)
            if close < 0:
                break
            at = close + 1
        self.endless.update(passed)
        return -1


def tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it is an end tag, attributes) of the tags of a page; comments and elements that are passed over have no name."""
    tags, at, endless = Tags(page), 0, set()
    after = lambda mark, k: n + len(mark) if (n := page.find(mark, k)) >= 0 else len(page)
    while (at := page.find("<", at)) >= 0:
        end, first = -1, at + 1 + page.startswith("/", at + 1)
        if page.startswith("<!--", at):
            end = after("-->", at + 4)
        elif page.startswith("<![CDATA[", at):
            end = after("]]>", at + 9)
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1 if at < tags.last else -1
        elif at < tags.last and "a" <= page[first : first + 1].lower() <= "z" and (end := tags.end(tags.name_end(first))) > 0:
            cut = tags.name_end(first)
            name, raw, closing = page[first:cut].lower(), page[cut : end - 1], first > at + 1
            passed = None
            if not closing and name in RAW:
                m = RAW[name].search(page, end)
                passed = m.end() if m else len(page)
            elif not closing and name in SKIPPED and name not in endless and not (name == "svg" and raw.endswith("/")):
                if m := SKIPPED[name].search(page, end):
                    passed = m.end()
                else:
                    endless.add(name)
            if passed is None:
                yield at, end, name, closing, raw
                at = end
                continue
            end = passed
        if end > 0:
            yield at, end, "", False, ""
        at = max(end, at + 1)


class Open:
    """The open elements of a page, inline ones too, with their block's node; what is open under a name is found at once."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    @property
    def node(self) -> int:
        return self.stack[-1][1]

    def push(self, tag: str, node: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, node))

    def last(self, tags: Iterable[str]) -> int:
        """The place of the innermost open element of these names; 0 if there is none."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def pop(self, to: int) -> list[str]:
        gone = [t for t, _ in self.stack[to:]]
        for t in gone:
            self.places[t].pop()
        while self.blocks and self.blocks[-1] >= to:
            self.blocks.pop()
        del self.stack[to:]
        return gone


def parse(page: str) -> Tree:
    """The page's block elements and text runs, parents before children, in time linear in the page.

    Tags that are left open or closed twice are mended as browsers do: a block closes an open
    paragraph, an item its sibling; an end tag without its start is passed over, and so is one
    of an inline element that was opened outside of the innermost block.
    """
    tree = Tree()
    nodes = tree.nodes
    nodes.append(Node(-1, "root", ("tag:root",)))
    held = Open()
    pieces: list[str] = []
    links, open_links, skipping = 0, 0, 0

    def flush() -> None:
        nonlocal links
        if pieces:
            text = "".join(pieces)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text and not skipping:
                at = held.node
                kind, seen = _run(text, min(links, len(text)), nodes[at].kind)
                nodes.append(Node(at, kind, seen, text, nodes[at].label))
            pieces.clear()
        links = 0

    def close(to: int) -> None:
        nonlocal open_links, skipping
        if held.blocks and held.blocks[-1] >= to:
            flush()
        gone = held.pop(to)
        open_links -= gone.count("a")
        skipping -= gone.count("head")

    last = 0
    for start, end, tag, closing, raw in tokens(page):
        if start > last:
            piece = page[last:start]
            pieces.append(piece)
            if open_links:
                links += len(piece)
        last = end
        if not tag:
            continue
        if closing:
            at = held.last((tag,))
            if at and not (tag in INLINE and held.blocks and held.blocks[-1] > at):
                close(at)
            continue
        if raw.endswith("/") and (tag == "svg" or tag in MATH):
            continue
        if tag in VOID:
            if tag == "br" or tag == "hr":
                pieces.append(" ") if tag == "br" else flush()
            continue
        if tag in INLINE:
            held.push(tag, held.node)
            open_links += tag == "a"
            continue
        flush()
        if tag in CLOSES_P and held.blocks and held.stack[held.blocks[-1]][0] == "p":
            close(held.blocks[-1])
        if tag in SIBLINGS:
            others, stops = SIBLINGS[tag]
            if (at := held.last(others)) > held.last(stops):
                close(at)
        attributes = _attributes(raw)
        kind, seen = _element(tag, attributes)
        marked = attributes.get("data-main")
        nodes.append(Node(held.node, kind, seen, None, int(marked) if marked in ("0", "1") else nodes[held.node].label))
        skipping += tag == "head"
        held.push(tag, len(nodes) - 1)
    if last < len(page):
        pieces.append(page[last:])
    flush()
    return tree


@dataclass
class PageModel:
    """Log potentials: of a node's label given its parent's, by kind; and of what is seen given the label."""

    edges: dict[tuple[str, int], float]
    seen: dict[str, float]
    edge_default: tuple[float, float] = (-3.0, 3.0)

    def marginals(self, tree: Tree) -> list[float]:
        """P(content) of each node by sum-product messages up and down the tree."""
        nodes, n = tree.nodes, len(tree.nodes)
        own = [0.0] * n  # log odds of content from the node and what is below it
        for i, node in enumerate(nodes):
            own[i] = sum(self.seen.get(f, 0.0) for f in node.seen)
        stay = [(0.5, 0.5)] * n
        up = [0.0] * n
        for i in range(n - 1, 0, -1):
            kind = nodes[i].kind
            p0, p1 = (_squash(self.edges.get((kind, k), self.edge_default[k])) for k in (0, 1))
            stay[i] = (p0, p1)  # P(content | parent's label)
            odds = math.exp(min(30.0, max(-30.0, own[i])))
            up[i] = math.log((p1 * odds + 1 - p1) / (p0 * odds + 1 - p0))
            own[nodes[i].parent] += up[i]
        down = [0.0] * n
        down[0] = -8.0  # the root is not content
        for i in range(1, n):
            parent = nodes[i].parent
            rest = math.exp(min(30.0, max(-30.0, down[parent] + own[parent] - up[i])))
            p0, p1 = stay[i]
            a, b = p1 * rest + p0, (1 - p1) * rest + 1 - p0
            down[i] = math.log(a / b)
        return [_squash(min(30.0, max(-30.0, own[i] + down[i]))) for i in range(n)]


def _squash(x: float) -> float:
    return 1 / (1 + math.exp(-x))


def train(pages: list[str], smooth: float = 0.5) -> PageModel:
    """Potentials from labelled pages, as smoothed counts."""
    edge: Counter = Counter()
    seen: Counter = Counter()
    total = [0, 0]
    for page in pages:
        nodes = parse(page).nodes
        for node in nodes[1:]:
            label, above = node.label or 0, nodes[node.parent].label or 0
            edge[node.kind, above, label] += 1
            total[label] += 1
            for f in node.seen:
                seen[f, label] += 1
    edges = {(kind, above): math.log((edge[kind, above, 1] + smooth) / (edge[kind, above, 0] + smooth)) for kind, above, _ in edge}
    # what is seen counts by half: tag, names and kind overlap
    marks = {f: 0.5 * math.log((seen[f, 1] + smooth) / (total[1] + 1) * (total[0] + 1) / (seen[f, 0] + smooth)) for f, _ in seen}
    return PageModel(edges, marks)


def main_text(page: str, model: PageModel, least: float = 0.5) -> str:
    tree = parse(page)
    chances = model.marginals(tree)
    return "\n".join(node.text for node, p in zip(tree.nodes, chances) if node.text is not None and p >= least)


def labelled_pages(count: int = 300, seed: int = 7) -> list[str]:
    """Pages of many layouts whose main text is known as they are made."""
    rng = random.Random(seed)
    letters = "etaoinshrdlucmfwypvbgk"

    def words(lo: int, hi: int, stop: str = ".") -> str:
        out = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(lo, hi))]
        return " ".join(out).capitalize() + (stop if rng.random() < 0.9 else "")

    def items(n: int, linked: bool = True) -> str:
        return "<ul>" + "".join(f"<li><a href='/{i}'>{words(1, 3, '')}</a></li>" if linked else f"<li>{words(3, 14)}</li>" for i in range(n)) + "</ul>"

    def named(tag: str, name: str, inside: str, label: int) -> str:
        how = rng.choice(("class", "id", "class", "role")) if name else ""
        return f"<{tag}{f' {how}={chr(34)}{name}{chr(34)}' if how else ''} data-main='{label}'>{inside}</{tag}>"

    def paragraph() -> str:
        text = words(*rng.choice(((1, 6), (4, 25), (20, 80), (60, 160))))
        kind = rng.random()
        if kind < 0.1:
            return f"<p><b>{text}<br>"
        if kind < 0.2:
            return f"<p>{text} <a href='/x'>{words(1, 4, '')}</a> {words(3, 20)}</p>"
        return f"<p>{text}</p>"

    def boiler() -> str:
        kind = rng.randrange(12)
        if kind == 0:
            return named("nav", rng.choice(("", "menu", "breadcrumb")), items(rng.randint(2, 9)), 0)
        if kind == 1:
            return named("div", rng.choice(("menu", "nav", "navbar", "main-menu", "breadcrumbs")), items(rng.randint(2, 9)), 0)
        if kind == 2:
            return named(rng.choice(("aside", "div")), rng.choice(("sidebar", "related", "widget", "more-links")), f"<h3>{words(1, 3, '')}</h3>" + items(rng.randint(2, 6)) + (f"<p>{words(5, 40)}</p>" if rng.random() < 0.5 else ""), 0)
        if kind in (3, 4):
            return named("div", rng.choice(("ad", "ads", "advert", "sponsored", "promo-box", "ad-banner")), words(3, 30) if rng.random() < 0.6 else f"<p>{words(3, 40)}</p>", 0)
        if kind == 5:
            return named("div", rng.choice(("cookie-notice", "consent", "gdpr-banner", "notice", "newsletter", "popup", "alert")), f"<p>{words(5, 35)}</p><button>{words(1, 2, '')}</button>", 0)
        if kind == 6:
            return named("form", rng.choice(("", "search", "newsletter", "login")), f"<label>{words(1, 4, '')}</label><input name='q'><p>{words(2, 15)}</p><button>{words(1, 2, '')}</button>", 0)
        if kind in (7, 8):
            inside = "".join(f"<div class='{rng.choice(('comment', 'reply', 'item'))}'><p>{words(3, 70)}</p></div>" if rng.random() < 0.7 else f"<p>{words(3, 50)}</p>" for _ in range(rng.randint(1, 5)))
            return named(rng.choice(("section", "div")), rng.choice(("comments", "comment-list", "disqus", "respond", "reviews")), f"<h3>{words(1, 3, '')}</h3>{inside}", 0)
        if kind == 9:
            return named("div", rng.choice(("share", "social")), items(rng.randint(2, 5)), 0)
        if kind == 10:
            return named("aside", "", f"<p>{words(4, 50)}</p>", 0)
        return named("div", rng.choice(("links", "tags", "pagination")), items(rng.randint(2, 6)), 0)

    pages = []
    for _ in range(count):
        body = [f"<h1>{words(2, 10, '')}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.randint(1, 12)):
            kind = rng.random()
            if kind < 0.75:
                body.append(paragraph())
            elif kind < 0.83:
                body.append(f"<h2>{words(1, 8, '')}</h2>")
            elif kind < 0.89:
                body.append(items(rng.randint(2, 5), False))
            elif kind < 0.92:
                body.append(f"<blockquote><p>{words(5, 40)}</p></blockquote>")
            elif kind < 0.94:
                body.append(f"<pre>{words(5, 20)}</pre>")
            elif kind < 0.96:
                body.append(f"<table><tr><td>{words(1, 5)}</td><td>{words(1, 5)}</td></tr></table>")
            elif kind < 0.98:
                body.append(boiler())
            else:
                body.append(f"<div>{paragraph()}</div>")
        tag, name = rng.choice((("article", ""), ("article", ""), ("article", "post"), ("main", ""), ("main", "content"), ("div", "content"), ("div", "article-body"), ("div", "entry-content"), ("section", "story"), ("div", "main-text"), ("div", "")))
        article = named(tag, name, "".join(body), 1)
        if rng.random() < 0.3:
            article = f"<{rng.choice(('main', 'div'))} class='{rng.choice(('wrapper', 'container', 'page', 'content'))}'>{boiler() if rng.random() < 0.4 else ''}{article}{boiler() if rng.random() < 0.4 else ''}</div>"
        top = [named("header", rng.choice(("", "site-header", "masthead")), (f"<h1>{words(1, 3, '')}</h1>" if rng.random() < 0.5 else "") + (items(rng.randint(2, 6)) if rng.random() < 0.6 else f"<p>{words(2, 8)}</p>"), 0)] if rng.random() < 0.5 else []
        foot = [named(rng.choice(("footer", "footer", "footer", "div")), rng.choice(("", "footer", "site-footer")) or "footer", rng.choice(("&copy; ", "")) + words(2, 14) + (items(3) if rng.random() < 0.3 else ""), 0)] if rng.random() < 0.85 else []
        pages.append("<!DOCTYPE html><html><head><title>x</title></head><body>" + "".join([*top, *(boiler() for _ in range(rng.randint(0, 4))), article, *(boiler() for _ in range(rng.randint(0, 3))), *foot]) + "</body></html>")
    return pages
