"""Main text of web pages by a tree-structured graphical model.

Each DOM node is content or not. A node's own tag, class words and text give its evidence, and a parent-child table
its tie to its parent. Messages passed up and down the tree (sum-product) give each node's marginal; text whose node is
more likely content than not is kept. Both tables are counted from labelled pages.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed values of HTML: elements without content, with raw text, those that stand in a line of text, and what closes a paragraph.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
SAME_CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
#: Elements at which a page's content or something else in it may begin.
BOXES = frozenset("html body div section article main aside header footer nav form ul ol dl table tbody tr td center fieldset ins #page".split())
#: Never text to read.
DEAD = frozenset("script style noscript template iframe svg title head textarea select button option object embed".split())

#: Deeper elements hang from this level, as in browsers: their text stays, and no page is slow to read.
DEEPEST = 512
_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"[^>\"']*")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_LONG_NUMBER, _ZEROS = re.compile(r"&#[1-9][0-9]{7,};?"), re.compile(r"&#0+(?=[0-9])")
_NAMED = re.compile(r"\b(class|id|role|aria-label|hidden|style)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"\shidden(\s|$|=)")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"[ \t\n\r\f\v ]+")


#: Added to counts of evidence: what is seen in one class alone is strong evidence.
SMOOTH = 0.02
#: Lengths and shares of links, of an element's own text and of all text in a box, are weaker evidence: log-odds at most.
MOST_ODDS = {"n": 1.0, "l": 1.0, "s": 1.0, "d": 3.0}


class Node:
    __slots__ = ("parent", "tag", "words", "chars", "linked", "label", "below", "below_linked")

    def __init__(self, parent: int, tag: str, words: tuple[str, ...], label: bool | None = None):
        self.parent, self.tag, self.words, self.chars, self.linked, self.label, self.below, self.below_linked = parent, tag, words, 0, 0, label, 0, 0


def decoded(text: str) -> str:
    """Text with its character references decoded; numbers beyond Unicode, however long, are one replacement character."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _LONG_NUMBER.sub("\ufffd", _ZEROS.sub("&#", text))
    return html.unescape(text)


class _Scanner:
    """Finds tags from left to right. What is not there is looked for once, so a page is read in linear time."""

    def __init__(self, page: str):
        self.page, self.none_after, self.quotes = page, {}, True

    def find(self, what: str, start: int) -> int:
        if start >= self.none_after.get(what, len(self.page) + 1):
            return -1
        at = self.page.find(what, start)
        if at < 0:
            self.none_after[what] = start
        return at

    def tag_end(self, start: int) -> int:
        """Where the > of a tag stands whose attributes begin at start; one in quotes is text of an attribute, if the quotes are closed.

        There is one. If all stand in quotes, the first ends the tag, and from then on quotes are not looked at.
        """
        at = start
        while self.quotes:
            at = _PLAIN.match(self.page, at).end()
            if at >= len(self.page) or self.page[at] == ">":
                break
            close = self.find(self.page[at], at + 1)
            at = close + 1 if close >= 0 else at + 1
        self.quotes = self.quotes and at < len(self.page)
        return at if self.quotes else self.find(">", start)


def parse(page: str) -> tuple[list[Node], list[tuple[int, int, str]]]:
    """Nodes, parents before children, and runs of text (node, block, decoded text) in page order.

    The reader forgives: unknown ends are dropped, open elements end with the page, a new block ends an open paragraph,
    a tag without its end is text. A block is the nearest element that is not inline, and a new one begins after each
    inner block or line break. Time is linear in the page: open elements are counted by tag, and nesting ends at DEEPEST.
    """
    nodes, stack, runs, block = [Node(-1, "#page", ())], [0], [], 0
    scan, at, n, opened = _Scanner(page), 0, len(page), Counter()

    def text(s: str) -> None:
        if s:
            node = stack[-1]
            runs.append((node, block, s := decoded(s)))
            size = len(s.strip())
            nodes[node].chars += size
            if opened["a"] and any(nodes[i].tag == "a" for i in stack[-3:]):
                nodes[node].linked += size

    def pop() -> str:
        tag = nodes[stack.pop()].tag
        opened[tag] -= 1
        return tag

    begin = 0  # of the text that was not emitted yet
    while at < n:
        at = page.find("<", at)
        if at < 0:
            break
        if page.startswith("<!--", at):
            end = scan.find("-->", at + 4)
            stop, tag = (end + 3 if end >= 0 else n), ""
        elif page.startswith("<![CDATA[", at) and (end := scan.find("]]>", at + 9)) >= 0:
            stop, tag = end + 3, ""
        elif page[at + 1 : at + 2] in ("!", "?") and (end := scan.find(">", at)) >= 0:
            stop, tag = end + 1, ""
        elif scan.find(">", at) < 0:
            break
        elif m := _TAG.match(page, at):
            end = scan.tag_end(m.end())
            stop, tag, close, rest = end + 1, m[1].lower(), page[at + 1] == "/", page[m.end() : end]
        else:
            at += 1
            continue
        text(page[begin:at])
        at = begin = stop
        if not tag:
            continue
        if tag not in INLINE:
            block += 1
        if close:
            if opened[tag]:
                while pop() != tag:
                    pass
            continue
        if tag not in INLINE and tag not in VOID and opened["p"]:
            while pop() != "p":
                pass
        elif tag in SAME_CLOSES:
            same = {tag, {"dt": "dd", "dd": "dt", "td": "th", "th": "td"}.get(tag, tag)}
            if any(opened[t] for t in same):
                for i in range(len(stack) - 1, 0, -1):
                    inner = nodes[stack[i]].tag
                    if inner in same:
                        while len(stack) > i:
                            pop()
                        break
                    if inner in SAME_CLOSES[tag]:
                        break
        named = {k.lower(): v.strip("\"'").lower() for k, v in _NAMED.findall(rest)} if "=" in rest else {}
        words = tuple(w for k in ("class", "id", "role", "aria-label") for w in _WORD.findall(named.get(k, "")))
        if "display:none" in named.get("style", "").replace(" ", "") or "hidden" in rest and _HIDDEN.search(rest):
            words += ("hidden",)
        label = {"1": True, "0": False}.get(m_label[1]) if "data-content" in rest and (m_label := re.search(r'data-content="([01])"', rest)) else None
        nodes.append(Node(stack[-1], tag, words, label))
        if tag not in VOID and not rest.endswith("/"):
            if len(stack) > DEEPEST:
                pop()
            stack.append(len(nodes) - 1)
            opened[tag] += 1
            if tag in RAW:
                close = _RAW_END[tag].search(page, at)
                runs.append((stack[-1], block, decoded(page[at : close.start() if close else n])))
                end = scan.find(">", close.end()) if close else -1
                at = begin = end + 1 if end >= 0 else n
                pop()
    text(page[begin:])
    for node in reversed(nodes):
        node.below, node.below_linked = node.below + node.chars, node.below_linked + (node.chars if node.tag == "a" else node.linked)
        if node.parent >= 0:
            nodes[node.parent].below += node.below
            nodes[node.parent].below_linked += node.below_linked
    return nodes, runs


def evidence(node: Node) -> list[str]:
    """What is seen of a node: its tag, class words, how much of its own text, if any, is links; and of a box that of all text in it.

    Words are other evidence on a box than on a paragraph or heading, which seldom stands alone for what it is called.
    """
    box = node.tag in BOXES
    seen = [f"t:{node.tag}", *{f"{'w' if box else 'p'}:{w}" for w in node.words}] if node.words else [f"bare:{node.tag}"]
    if node.chars:
        seen += [f"n:{min(6, int(math.log2(1 + node.chars / 8)))}", f"l:{round(2 * node.linked / node.chars)}"]
    if box:
        seen += [f"s:{min(6, int(math.log2(1 + node.below / 32)))}", f"d:{round(4 * node.below_linked / node.below)}" if node.below else "d:-"]
    return seen


#: Kinds of elements by how they go with their parent; all others, which stand in a line or a paragraph, are parts.
KINDS = {
    **dict.fromkeys(BOXES, "box"),
    **dict.fromkeys("section article main body html #page".split(), "section"),
    **dict.fromkeys("ul ol dl table tbody tr td".split(), "list"),
}


def _kind(tag: str) -> str:
    return KINDS.get(tag, "part")


class Model:
    """Counts of evidence by class, and of a node's class by its parent's and its own kind."""

    def __init__(self) -> None:
        self.seen = {True: Counter(), False: Counter()}
        self.size = {True: 0, False: 0}
        self.pair: dict[tuple[str, bool], Counter] = defaultdict(Counter)

    def learn(self, page: str) -> None:
        """Count a labelled page: elements with data-content="1" or "0" set their class and that of all below them."""
        nodes, _ = parse(page)
        classes: list[bool] = []
        for node in nodes:
            own = node.label if node.label is not None else (classes[node.parent] if node.parent >= 0 else False)
            classes.append(own)
            self.seen[own].update(evidence(node))
            self.size[own] += 1
            if node.parent >= 0:
                self.pair[_kind(node.tag), classes[node.parent]][own] += 1

    def ready(self) -> "Model":
        n1, n0 = self.size[True] + 1, self.size[False] + 1
        self.odds: dict[str, float] = defaultdict(float)
        for e in {*self.seen[True], *self.seen[False]}:
            most = MOST_ODDS.get(e.split(":")[0], math.inf)
            self.odds[e] = max(-most, min(most, math.log((self.seen[True][e] + SMOOTH) / n1) - math.log((self.seen[False][e] + SMOOTH) / n0)))
        counts = lambda k, c, d: (self.pair[k, c][d] + 0.5) / (sum(self.pair[k, c].values()) + 1)
        self.tie = {k: [counts(k, c, d) for c in (True, False) for d in (True, False)] for k in ("section", "box", "list", "part")}
        return self

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability that each node is content: messages from the leaves to the root, then back."""
        ties = [self.tie[_kind(node.tag)] for node in nodes]  # content under content, other under content, content under other, other under other
        n = len(nodes)
        own, up1, up0 = [0.0] * n, [0.0] * n, [0.0] * n  # log-odds of the evidence; log messages gathered from children
        to1, to0 = [0.0] * n, [0.0] * n
        for i, node in enumerate(nodes):
            own[i] = max(-20.0, min(20.0, sum(self.odds[e] for e in evidence(node) if e in self.odds)))
        for i in range(n - 1, 0, -1):
            (t11, t10, t01, t00), a, b = ties[i], own[i] + up1[i], up0[i]
            top = max(a, b)
            a, b = math.exp(a - top), math.exp(b - top)
            to1[i], to0[i] = math.log(t11 * a + t10 * b) + top, math.log(t01 * a + t00 * b) + top
            p = nodes[i].parent
            up1[p] += to1[i]
            up0[p] += to0[i]
        down1, down0 = [0.0] * n, [0.0] * n
        down1[0], down0[0] = math.log(0.01), math.log(0.99)
        out = [0.0] * n
        for i, node in enumerate(nodes):
            if i:
                (t11, t10, t01, t00), p = ties[i], node.parent
                a, b = own[p] + up1[p] - to1[i] + down1[p], up0[p] - to0[i] + down0[p]
                top = max(a, b)
                a, b = math.exp(a - top), math.exp(b - top)
                s = a + b
                down1[i], down0[i] = math.log((t11 * a + t01 * b) / s), math.log((t10 * a + t00 * b) / s)
            d = own[i] + up1[i] + down1[i] - up0[i] - down0[i]
            out[i] = 1 / (1 + math.exp(-max(-500.0, min(500.0, d))))
        return out


#: Labelled pages: layouts written for this purpose, with what is content marked on the elements.
_SENTENCES = (
    "One sentence of some length that tells what it is about, and <a href='/x'>a link</a> to more.", "Another <b>one</b> here, longer than the first, to make the point again in other words for the reader, who may have missed it.",
    "Short end.", "It was a cold day, and nobody had thought of bringing wood.", "Yes.", "The figures of the year before had been lower, by a third or so, as the table below shows; they rose again in spring.",
)
_PARTS = (
    "<h2{}>Part</h2>", "<h3{}>Smaller part</h3>", "<ul{}><li>first thing that counts</li><li>second thing, a bit longer than that</li></ul>", "<ol{}><li>then this</li><li>then that</li></ol>", "<ul{}><li>tea</li><li>salt</li></ul>", "<table{}><tr><td>1</td></tr></table>",
    "<blockquote{}><p>said by someone else, in a few words</p></blockquote>", "<figure{}><img src='x'><figcaption>what the picture shows</figcaption></figure>", "<table{}><tr><th>year</th><td>12</td></tr><tr><th>month</th><td>7</td></tr></table>", "<pre{}>code = 1</pre>",
    "<div{}><p>%s</p><p>%s</p></div>", "<section{}><h2>More of it</h2><p>%s</p><p>%s</p></section>", "<dl{}><dt>word</dt><dd>what it means</dd></dl>", "<hr>",
)
#: Names that parts of an article carry, some of them names of boxes around articles as well.
_NAMES = ("", "", "", "", "lead", "intro", "text", "notice", "more", "note", "first", "caption", "summary", "highlight", "header", "body", "meta", "promo", "quote", "tags", "related", "footer", "share", "alert")
_LINKS = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About us</a></li></ul>'
_BOXES = (
    "<nav{}>%s</nav>" % _LINKS, '<div class="menu"{}>%s</div>' % _LINKS, '<ul class="nav navbar breadcrumb"{}><li><a href="/">Start</a></li></ul>', '<div role="navigation" id="menu"{}>%s</div>' % _LINKS,
    '<header{}><a href="/">Site name</a><p>Motto of the site</p></header>', '<div class="header banner masthead" id="header"{}><p>Name of the site</p></div>', '<div class="topbar" role="banner"{}>Welcome</div>',
    '<div class="ad"{}>Buy this now, it is cheap and good and yours in a day.</div>', '<div class="ads advert advertisement sponsored promo"{}><p>Offers of the week for you</p><a href="/s">Shop</a></div>', '<ins class="adsbygoogle ad banner"{}>ad</ins>',
    '<aside{}><h3>Related</h3>%s<p>A note at the side, about other things than these.</p></aside>' % _LINKS, '<div class="sidebar widget" id="sidebar"{}><h3>Popular</h3>%s<p>Words at the side.</p></div>' % _LINKS, '<div class="related recommended more"{}><h3>Read on</h3>%s</div>' % _LINKS,
    '<div class="cookie consent notice banner" id="cookie"{}><p>We use cookies to make this site work. By going on you agree.</p><button>OK</button></div>', '<div class="popup modal overlay newsletter subscribe signup"{}><p>Get our letter by mail every week.</p><form><input><button>Go</button></form></div>', '<div class="notice alert gdpr privacy disclaimer" role="alert"{}>Please note our terms of use before you go on.</div>',
    '<form class="search login"{}><label>Search</label><input><button>Find</button></form>', '<div class="share social tools"{}><a href="/f">Share</a> <a href="/t">Post</a></div>', '<div class="tags meta byline pagination pager"{}><a href="/1">1</a> <a href="/2">next</a></div>',
    '<section class="comments comment replies" id="comments"{}><h3>2 comments</h3><div class="comment"><p>I read this with joy and do not agree with any of it, but thanks anyway.</p></div><div class="comment reply"><p>So do I, though for other reasons that are longer than yours.</p></div></section>', '<div class="comment-list disqus discussion responses"{}><article class="comment"><p>Someone says a thing or two about what was said above.</p></article></div>',
    '<footer{}><p>&copy; name of the site &middot; All rights reserved in some words.</p></footer>', '<div class="footer copyright legal" id="footer" role="contentinfo"{}><p>Imprint and terms, and who owns them.</p>%s</div>' % _LINKS,
    "<script{}>var t = 1;</script>", "<style{}>p{{margin:0}}</style>", "<noscript{}>no script here</noscript>",
)
_MAINS = (
    "<article{}>%s</article>", "<main{}>%s</main>", "<main{}><article>%s</article></main>", '<div class="content main" id="content"{}>%s</div>', '<div class="article post entry story"{}>%s</div>', '<section class="article-body post-content entry-content"{}>%s</section>',
    '<div role="main" id="main"{}><div class="text body">%s</div></div>', '<article class="post"{}><div class="entry">%s</div></article>', "<article{}><section>%s</section></article>", "<article{}><header><h1>Head of it</h1></header>%s</article>", "<div{}>%s</div>", "%s", "%s", "%s",
)


def _article(rng: random.Random, boxes: list[str]) -> str:
    """A body of paragraphs and other parts in any order; boxes stand between its parts."""
    named = lambda: f' class="{n}"' if (n := rng.choice(_NAMES)) and rng.random() < 0.4 else ""
    sentences = lambda: " ".join(rng.choice(_SENTENCES) for _ in range(rng.choice((1, 1, 2, 3, 8))))
    parts = ["<h1>Title of it</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.choice((1, 2, 2, 3, 5, 9))):
        parts.append(f"<p{named()}>{sentences()}</p>")
        if rng.random() < 0.4:
            part = rng.choice(_PARTS).format(named())
            parts.append(part % tuple(sentences() for _ in range(part.count("%s"))))
    for box in boxes:
        parts.insert(rng.randint(min(1, len(parts)), len(parts)), box)
    return "".join(parts)


def labelled_pages(seed: int = 7, rounds: int = 3) -> list[str]:
    """Each main layout, and a body without one, with each box around it or inside it, in turn; articles are made at random from the seed."""
    on, off, pages, rng = ' data-content="1"', ' data-content="0"', [], random.Random(seed)

    def filled(box: str) -> str:
        """The box, now and then with more text in it."""
        box, more = box.format(off), "<p>" + " ".join(rng.choice(_SENTENCES) for _ in range(rng.choice((1, 2, 4)))) + "</p>"
        at = box.rfind("</")
        return box[:at] + more + box[at:] if rng.random() < 0.3 and not box.endswith(("script>", "style>", "ul>")) else box

    for k, main in enumerate(_MAINS * rounds):
        for j in range(0, len(_BOXES), 2):
            a, b, c = (filled(_BOXES[(j + d * (k + 1)) % len(_BOXES)]) for d in (0, 5, 11))
            inside = [b, c] if rng.random() < 0.35 else []
            head = "<!DOCTYPE html><html><head><meta charset='utf-8'><title>Title of it</title></head>"
            inner = _article(rng, inside)
            if main == "%s":
                pages.append(f"{head}<body{on}>{a}{inner}{b}</body></html>")
                continue
            wrap = ("%s", '<div class="wrap container page row" id="wrapper">%s</div>')[j % 4 // 2]
            outside = rng.sample(_BOXES, rng.randint(0, 3))
            pages.append(f"{head}<body>{wrap % (a + main.format(on) % inner + ('' if inside else b) + ''.join(map(filled, outside)))}</body></html>")
    return pages


def trained(pages: list[str] | None = None) -> Model:
    model = Model()
    for page in pages or labelled_pages():
        model.learn(page)
    return model.ready()


def main_text(page: str, model: Model) -> str:
    """Text of the content nodes: white space in a block becomes one space, blocks are joined by one."""
    nodes, runs = parse(page)
    marginal = model.marginals(nodes)
    dead = [False] * len(nodes)
    for i, node in enumerate(nodes):
        dead[i] = node.tag in DEAD or "hidden" in node.words or (node.parent >= 0 and dead[node.parent])
    blocks: list[tuple[int, list[str]]] = []
    for node, block, text in runs:
        if marginal[node] > 0.5 and not dead[node]:
            if not blocks or blocks[-1][0] != block:
                blocks.append((block, []))
            blocks[-1][1].append(text)
    return " ".join(filter(None, (_SPACE.sub(" ", "".join(parts)).strip() for _, parts in blocks)))


def extract_main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """One row for each row of pages (page_id, url, html): page_id, url, text, n_chars.

    Null html is an empty page: text is empty, n_chars 0. Nothing is capped; a page is read whole. Repeated rows are
    read each; an empty table gives no rows; other columns are ignored. Without a model, one is trained from
    labelled_pages(), a fixed set of layouts, and sent with the tasks.
    """
    model = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py() or "", model) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    pages = pages.select("page_id", "url", "html")
    return pages.mapInArrow(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
