"""Main text of web pages: boosted trees over DOM nodes, then hierarchical decoding.

Every block element of a page is a node with features of itself, its subtree (text density, links), its
attribute tokens, its depth, its ancestors and its siblings. Boosted trees give each node the
probability that its subtree is main text. Decoding walks the tree from below: a node is kept whole, dropped
whole, or split among its children, whichever is likeliest over the subtree. A kept node thus has no dropped
descendant, a dropped one no kept descendant.

The trees are fitted on a bounded sample of the pages themselves (``max_pages``): nodes inside or outside the page's article
element give the labels, and each page is also laid out anew from its own pieces (other containers, menus, sidebars,
notices, adverts, forms, reader comments), so that the model learns layout and not one element's name.
"""

from __future__ import annotations

import html
import random
import re
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.boosting import fit_boosted_trees, predict
from churnlake.llm.common import md5_unit, stage, text_batches

# HTML element names by kind, and attribute tokens by what they commonly name.
BLOCK = frozenset("html body article section main aside nav header footer div p ul ol li dl dt dd table thead tbody tfoot tr td th caption h1 h2 h3 h4 h5 h6 hgroup blockquote pre figure figcaption form fieldset legend details summary address center hr dialog menu search label select option button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSHOWN = frozenset("script style title noscript template svg iframe object canvas audio video textarea".split())
CLOSED = frozenset("svg object canvas audio video".split())  # of these, ordinary elements: without an end tag only the start tag is skipped
ENDED_BY = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
ENDED_BY = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDED_BY.items()}
TOKENS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager tabs toc skip",
    "header": "header masthead banner logo branding site-title tagline hero",
    "footer": "footer foot copyright colophon legal bottom",
    "side": "sidebar side aside widget widgets rail related recommended popular trending more archive tags categories",
    "advert": "ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion promoted affiliate banner-ad",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe paywall disclaimer message toast",
    "form": "form search login signup signin register field input contact poll survey",
    "comment": "comment comments reply replies respond discussion disqus reader readers responses feedback",
    "share": "share sharing social follow facebook twitter byline author meta metadata date",
    "content": "article content post entry story main text body page-content article-body post-content entry-content copy",
}
TOKEN_GROUP = {w: k for k, words in enumerate(TOKENS.values()) for w in words.split()}
GROUPS = len(TOKENS)
CONTENT = 1 << list(TOKENS).index("content")
NEVER_MAIN = sum(1 << k for k, name in enumerate(TOKENS) if name in ("menu", "advert", "notice", "form", "comment"))
TAGS = ["body", "article", "section", "main", "aside", "nav", "header", "footer", "div", "p", "ul", "li", "table", "heading", "form", "blockquote", "other"]
TAG_NUMBER = {t: k for k, t in enumerate(TAGS)} | {f"h{k}": TAGS.index("heading") for k in range(1, 7)} | {t: TAGS.index("form") for t in "fieldset legend label select option button search".split()} | {"ol": TAGS.index("ul"), "menu": TAGS.index("ul"), "pre": TAGS.index("blockquote"), "tr": TAGS.index("table"), "td": TAGS.index("table"), "th": TAGS.index("table")}
# A tag after its "<" or "</": name, then attributes up to ">". Values may be quoted; a quote elsewhere, or one that never closes, is a character like any other.
TAG = re.compile(r"""([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+)>""")
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
WORDS = re.compile(r"[a-z][a-z-]*")


RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in UNSHOWN}


def tags(source: str) -> list[tuple[int, int, bool, str, str]]:
    """(begin, end, whether an end tag, lower-case name, attributes) of all tags, from left to right in one pass.

    Comments and declarations come with an empty name; what holds raw text (script, style, ...) reaches to its end tag's end, or the page's. Where a
    tag never ends because a quote swallows the rest of the page, this and all later tags end at their next ">" instead.
    """
    out, at, last, quotes = [], 0, source.rfind(">"), True
    while 0 <= (begin := source.find("<", at)) < last:
        mark = source[begin + 1 : begin + 2]
        if mark in ("!", "?"):
            if source.startswith("<!--", begin):
                end = source.find("-->", begin + 2)
                end = end + 3 if end >= 0 else len(source)
            else:
                end = source.find(">", begin) + 1
            out.append((begin, end, False, "", ""))
            at = end
            continue
        closing = mark == "/"
        first = source[begin + 1 + closing : begin + 2 + closing]
        if not (first.isascii() and first.isalpha()):
            at = source.find(">", begin) + 1 if closing else begin + 1
            if closing:
                out.append((begin, at, False, "", ""))
            continue
        m = TAG.match(source, begin + 1 + closing) if quotes else None
        if m:
            name, attrs, at = m[1].lower(), m[2], m.end()
        else:
            quotes, at = False, source.find(">", begin) + 1
            inner = source[begin + 1 + closing : at - 1]
            name = re.match(r"[^\s/]*", inner)[0].lower()
            attrs = inner[len(name) :]
        if name in RAW_END and name not in CLOSED and not closing and (name in ("script", "style") or not attrs.endswith("/")):
            e = RAW_END[name].search(source, at)
            at = source.find(">", e.end()) + 1 if e else len(source)
            at = at or len(source)
        out.append((begin, at, closing, name, attrs))
    return out


def closed_ends(found: list[tuple[int, int, bool, str, str]]) -> dict[int, int]:
    """Of each svg, object, ... with an end tag: the number of that end tag, by the number of its start tag."""
    ends, open_at = {}, {name: [] for name in CLOSED}
    for k, (_, _, closing, name, attrs) in enumerate(found):
        if name in CLOSED:
            if not closing:
                if not attrs.endswith("/"):
                    open_at[name].append(k)
            elif open_at[name]:
                ends[open_at[name].pop()] = k
    return ends


class Page:
    """Block elements in page order: tag, attribute text, parent, depth; and blocks of text with their element."""

    __slots__ = ("tag", "attrs", "parent", "depth", "blocks")

    def __init__(self) -> None:
        self.tag, self.attrs, self.parent, self.depth, self.blocks = ["body"], [""], [-1], [0], []


def parse(source: str) -> Page:
    """A forgiving reader: unclosed p, li, cell and inline elements end where HTML ends them; stray end tags are skipped.

    Linear in the page but for look-ups among open elements of one name, which are by bisection.
    """
    page, buffer, at, linked = Page(), [], 0, 0
    stack = [("body", 0)]  # open elements: name, node (-1: inline)
    blocks = [0]  # places in the stack of the block elements
    places: dict[str, list[int]] = {}  # of each open element's name, its places in the stack
    owner, links, number = 0, 0, 0
    found = tags(source)
    ends = closed_ends(found)

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                page.blocks.append((owner, text, min(linked, len(text))))
            buffer.clear()
        linked = 0

    def text(part: str) -> None:
        nonlocal linked
        buffer.append(part)
        if links:
            linked += len(part.strip())

    def push(name: str, node: int) -> None:
        places.setdefault(name, []).append(len(stack))
        if node >= 0:
            blocks.append(len(stack))
        stack.append((name, node))

    def pop_to(k: int) -> None:
        nonlocal owner, links
        while len(stack) > k:
            name, node = stack.pop()
            places[name].pop()
            links -= name == "a"
            if node >= 0:
                blocks.pop()
        owner = stack[blocks[-1]][1]

    while number < len(found):
        begin, end, closing, name, attrs = found[number]
        number += 1
        if begin > at:
            text(source[at:begin])
        at = end
        if not name:
            continue
        if closing:
            if name in BLOCK:
                flush()
            k = places[name][-1] if places.get(name) else 0
            if k and (name in BLOCK or k > blocks[-1]):  # an inline element does not end across a block
                pop_to(k)
            continue
        if name in UNSHOWN:
            if number - 1 in ends:
                number = ends[number - 1] + 1
                at = found[number - 1][1]
            if name != "title":
                buffer.append(" ")
            continue
        if name in VOID and name != "hr":
            buffer.append(" " if name in ("br", "img", "input") else "")
            continue
        if name in BLOCK:
            flush()
            if stack[blocks[-1]][0] == "p" and blocks[-1]:  # a p ends at the next block, and inline elements in it
                pop_to(blocks[-1])
            if name in ("html", "body"):
                continue
            if name in ENDED_BY:
                before, within = ENDED_BY[name]
                stop = max((places[x][-1] for x in within if places.get(x)), default=0)
                last = min((places[x][k] for x in before if x in places and (k := bisect_right(places[x], stop)) < len(places[x])), default=0)
                if last:
                    pop_to(last)
            if name == "hr":
                continue
            page.tag.append(name)
            page.attrs.append(attrs)
            page.parent.append(owner)
            page.depth.append(page.depth[owner] + 1)
            owner = len(page.tag) - 1
            push(name, owner)
        elif not attrs.endswith("/"):
            push(name, -1)
            links += name == "a"
    if at < len(source):
        text(source[at:])
    flush()
    return page


def attribute_groups(attrs: str) -> int:
    """The token groups named in class, id and role, as bits."""
    bits = 0
    for value in NAMES.findall(attrs):
        for w in WORDS.findall(value.lower().replace("_", "-")):
            for part in (w, *w.split("-")):
                if (g := TOKEN_GROUP.get(part)) is not None:
                    bits |= 1 << g
    return bits


N_FEATURES = 21 + len(TAGS) + 2 * GROUPS


def node_features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """The features of all nodes of all pages, one row a node, and the rows where pages start."""
    sizes = np.array([len(p.tag) for p in pages])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    n = int(starts[-1])
    parent, own, tag, bits = np.full(n, -1), np.zeros((n, 5)), np.zeros(n, np.int64), np.zeros(n, np.int64)
    depth = np.zeros(n)
    groups: dict[str, int] = {"": 0}
    for s, p in zip(starts, pages):
        parent[s : s + len(p.tag)] = [q + s if q >= 0 else -1 for q in p.parent]
        tag[s : s + len(p.tag)] = [TAG_NUMBER.get(t, len(TAGS) - 1) for t in p.tag]
        depth[s : s + len(p.tag)] = p.depth
        for k, a in enumerate(p.attrs):
            if a:
                if a not in groups:
                    groups[a] = attribute_groups(a)
                bits[s + k] = groups[a]
        for o, t, linked in p.blocks:
            own[s + o] += (len(t), linked, t.count(" ") + 1, t.count(".") + t.count(","), 1)
    sub = np.column_stack([own, np.ones(n)])  # text, linked, words, stops, blocks, nodes of the subtree
    above, tags_above = bits.copy(), 1 << tag
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.searchsorted(depth[order], np.arange(1, int(depth.max()) + 1)))
    for rows in levels[1:]:
        above[rows] |= above[parent[rows]]
        tags_above[rows] |= tags_above[parent[rows]]
    for rows in reversed(levels[1:]):
        np.add.at(sub, parent[rows], sub[rows])
    up = np.maximum(parent, 0)
    brothers = np.bincount(up[parent >= 0], minlength=n)[up]
    page_of = np.repeat(np.arange(len(pages)), sizes)
    total = sub[starts[:-1]][page_of]
    before = np.cumsum(own[:, 0]) - own[:, 0]
    place = before - before[starts[:-1]][page_of]
    same = np.zeros(n)
    key = up * len(TAGS) + tag
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    same = count[inverse]
    size = np.maximum(sub[:, 0], 1)
    columns = [
        np.log1p(own[:, 0]), np.log1p(sub[:, 0]), own[:, 1] / np.maximum(own[:, 0], 1), sub[:, 1] / size,
        sub[:, 0] / sub[:, 5], np.log1p(sub[:, 5]), np.log1p(sub[:, 2]), sub[:, 3] / np.maximum(sub[:, 2], 1), sub[:, 0] / np.maximum(sub[:, 2], 1),
        sub[:, 0] / np.maximum(sub[:, 4], 1), depth, np.arange(n) - starts[:-1][page_of], place / np.maximum(total[:, 0], 1), sub[:, 0] / np.maximum(total[:, 0], 1),
        brothers, same, sub[up, 0] / np.maximum(sub[up, 4], 1), sub[up, 1] / np.maximum(sub[up, 0], 1), np.log1p(sub[up, 0]), sizes[page_of], np.where(parent >= 0, sub[:, 0] / np.maximum(sub[up, 0], 1), 1),
    ]
    flags = [(tags_above >> k) & 1 for k in range(len(TAGS))]
    flags += [(bits >> k) & 1 for k in range(GROUPS)] + [(above >> k) & 1 for k in range(GROUPS)]
    return np.column_stack([*columns, *flags]).astype(np.float32), starts


def decode(page: Page, p: np.ndarray, split_cost: float = 1.0) -> list[str]:
    """The text blocks of the likeliest consistent choice: whole subtrees kept or dropped, or split among the children."""
    n = len(page.tag)
    p = np.clip(p, 1e-4, 1 - 1e-4)
    yes, no = np.log(p).tolist(), np.log(1 - p).tolist()
    filled = [False] * n
    for o, _, _ in page.blocks:
        filled[o] = True
    keep, drop, mixed = [0.0] * n, [0.0] * n, [-split_cost] * n
    shown = filled[:]
    for k in range(n - 1, -1, -1):
        if filled[k]:
            mixed[k] += max(yes[k], no[k])
        if shown[k]:
            keep[k] += yes[k]
            drop[k] += no[k]
        if (q := page.parent[k]) >= 0:
            shown[q] = shown[q] or shown[k]
            keep[q] += keep[k]
            drop[q] += drop[k]
            mixed[q] += max(keep[k], drop[k], mixed[k])
    chosen: list[bool | None] = [None] * n  # None: split
    own = [False] * n
    for k in range(n):
        q = page.parent[k]
        if q >= 0 and chosen[q] is not None:
            chosen[k] = chosen[q]
        else:
            best = max(keep[k], drop[k], mixed[k])
            chosen[k] = True if best == keep[k] else False if best == drop[k] else None
        own[k] = yes[k] >= no[k] if chosen[k] is None else chosen[k]
    return [t for o, t, _ in page.blocks if own[o]]


def extract_batch(model: dict[str, np.ndarray], sources: list[str]) -> list[str]:
    pages = [parse(s) for s in sources]
    if not pages:
        return []
    x, starts = node_features(pages)
    p = predict(model, x)
    return ["\n".join(decode(page, p[a:b])) for page, a, b in zip(pages, starts, starts[1:])]


def relaid(page: Page, pieces: list[str], rng: random.Random) -> str:
    """A page of another layout made of a page's own main blocks and of pieces of text; main text is marked data-main."""
    main = [t for o, t, _ in page.blocks if inside(page, o, "article")] or [rng.choice(pieces)]
    say = lambda n: html.escape(" ".join(rng.choice(pieces).split()[:n]))
    link = lambda: f'<a href="/{rng.randrange(999)}">{say(rng.randint(1, 4))}</a>'
    named = lambda group: f'{rng.choice(["class", "id"])}="{rng.choice(TOKENS[group].split())}"'
    paragraphs = lambda n: "".join(f"<p>{say(rng.randint(5, 60))}</p>" for _ in range(n))
    listed = lambda n: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>"
    if rng.random() < 0.25:  # a short article
        main = main[: rng.randint(1, 3)]
    icon = lambda: rng.choice(["", "", '<svg width="9"><title>x</title><path d="M0 0"/></svg>', "<img src=x>"])
    made = []
    for k, b in enumerate(main):
        shape, b = rng.random(), html.escape(b)
        if k == 0:
            made.append(f"<h1>{b}</h1>" if rng.random() < 0.8 else f"<p>{b}</p>")
        elif shape < 0.75:
            made.append(f"<p>{b}</p>")
        elif shape < 0.82:
            made.append(f"<blockquote>{b}</blockquote>")
        elif shape < 0.9:
            made.append(f"<ul><li>{icon()}{b}<li>{say(rng.randint(3, 25))}</ul>")
        elif shape < 0.95:
            made.append(f"<table><tr><td>{b}<td>{say(rng.randint(1, 12))}</table>")
        else:
            made.append(f"<div><p>{b}</p></div>")
    body = "".join(made)
    opened = rng.choice(["article", "main", "div " + named("content"), "section " + named("content"), "div", "article " + named("content")])
    content = f'<{opened} data-main="1">{body}</{opened.split()[0]}>'
    if rng.random() < 0.3:
        content = content.replace("</p>", f'</p><div {named("advert")}>{say(rng.randint(3, 40))}</div>', 1)
    parts = {
        "header": [f"<header><h1>{say(4)}</h1><p>{say(10)}</p></header>", f"<div {named('header')}><p>{say(8)}</p></div>"],
        "menu": [f"<nav>{listed(rng.randint(2, 9))}</nav>", f"<ul {named('menu')}>" + "".join(f"<li>{icon()}{link()}" for _ in range(rng.randint(2, 7))) + "</ul>", f"<div {named('menu')}>{listed(rng.randint(2, 9))}</div>", listed(rng.randint(4, 9)), f"<nav>{link()} | {link()} | {link()}</nav>"],
        "side": [f"<aside>{paragraphs(rng.randint(1, 4))}</aside>", f"<div {named('side')}>{paragraphs(rng.randint(2, 10))}</div>", f"<div {named('side')}><h3>{say(3)}</h3>{listed(5)}</div>", f"<aside><h2>{say(2)}</h2>{listed(6)}</aside>"],
        "advert": [f"<div {named('advert')}>{say(rng.randint(3, 50))}</div>", f"<section {named('advert')}>{paragraphs(1)}</section>"],
        "notice": [f"<div {named('notice')}><p>{say(rng.randint(8, 40))}</p><button>{say(2)}</button></div>", f'<div role="alert">{say(12)}</div>'],
        "form": [f"<form><label>{say(2)}</label><input><select><option>{say(1)}</option><option>{say(1)}</option></select><button>{say(1)}</button></form>", f"<form {named('form')}><p>{say(rng.randint(4, 30))}</p><input></form>"],
        "comment": [f"<section {named('comment')}><h2>{say(2)}</h2>" + "".join(f"<div><p>{say(3)}</p><p>{say(rng.randint(5, 60))}</p></div>" for _ in range(rng.randint(1, 5))) + "</section>", f"<div {named('comment')}>{paragraphs(rng.randint(1, 6))}</div>", f"<ol {named('comment')}>" + "".join(f"<li><p>{say(rng.randint(5, 50))}</p></li>" for _ in range(3)) + "</ol>"],
        "footer": [f"<footer><p>{say(20)}</p></footer>", f"<footer>&copy; {say(3)} &middot; {say(rng.randint(3, 20))}</footer>", f"<div {named('footer')}><p>{say(14)}</p>{listed(3)}</div>"],
        "share": [f"<div {named('share')}>{link()}{link()}</div>"],
    }
    picked = [k for k in parts if rng.random() < 0.6]
    front = [rng.choice(parts[k]) for k in ("header", "menu", "notice", "advert", "form") if k in picked]
    back = [rng.choice(parts[k]) for k in ("share", "side", "advert", "comment", "form", "notice") if k in picked]
    rng.shuffle(back)
    inner = "".join(front) + content + "".join(back)
    if rng.random() < 0.2 and "comment" in picked:  # comments within the article element
        inner = inner.replace("</article>", f'<section {named("comment")} data-main="0">{paragraphs(2)}</section></article>', 1)
    inner = f"<div>{inner}</div>" if rng.random() < 0.4 else inner
    return f"<html><body>{inner}{rng.choice(parts['footer']) if 'footer' in picked else ''}</body></html>"


def inside(page: Page, node: int, tag: str) -> bool:
    while node >= 0:
        if page.tag[node] == tag:
            return True
        node = page.parent[node]
    return False


def node_labels(page: Page, marked: bool = False) -> np.ndarray:
    """1 and 0 for nodes whose text is all main or none of it, -1 where it is mixed or there is none.

    ``marked``: a page laid out anew, whose main text is in elements marked data-main="1" (and "0" where it ends). On other
    pages main text is what the article element holds, without what is named as comments, adverts and the like in it.
    """
    own = np.zeros(len(page.tag))
    for k, (a, t) in enumerate(zip(page.attrs, page.tag)):
        q = page.parent[k]
        own[k] = own[q] if q >= 0 else 0
        named = attribute_groups(a)
        if marked:
            if 'data-main="1"' in a:
                own[k] = 1
            elif 'data-main="0"' in a or (own[k] and named):
                own[k] = 0
        elif t == "article":
            own[k] = 0 if named & NEVER_MAIN or (q >= 0 and own[q] == 0 and inside(page, q, "article")) else 1
        elif t in ("nav", "aside", "footer", "header", "form") or named & NEVER_MAIN or (named & ~CONTENT and not named & CONTENT):
            own[k] = 0
    count = np.zeros((len(page.tag), 2))
    for o, t, _ in page.blocks:
        count[o, int(own[o])] += len(t)
    for k in range(len(page.tag) - 1, 0, -1):
        count[page.parent[k]] += count[k]
    total = count.sum(axis=1)
    return np.where(total == 0, -1, np.where(count[:, 1] == total, 1, np.where(count[:, 0] == total, 0, -1)))


def has_main_text(page: Page) -> bool:
    """Whether the page labels itself: it has text in an article element."""
    return "article" in page.tag and any(inside(page, o, "article") for o, _, _ in page.blocks)


def _first_labelled(most: int):
    """(u, digest, labelled) per task: its first ``most`` pages by (u, digest) that label themselves, and one page with text that does not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, other = [], []
        for b in batches:
            for u, digest, source in zip(*(c.to_pylist() for c in b.columns)):
                row = (u, digest, len(source))
                if len(best) == most and row >= best[-1]:
                    continue  # not parsed: too late in the order
                if has_main_text(parse(source)):
                    if row not in best:
                        insort(best, row)
                        del best[most:]
                elif not other:
                    other.append(row)
        rows = [(*x, True) for x in best] + [(*x, False) for x in other]
        cols = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.float64(), pa.int64(), pa.int64(), pa.bool_()))], names=["u", "digest", "size", "labelled"])

    return run


def fit(pages: DataFrame, max_pages: int = 300, copies: int = 3, seed: int = 7, max_chars: int = 50_000_000, id_col: str = "page_id", html_col: str = "html") -> dict[str, np.ndarray]:
    """Trees from at most ``max_pages`` pages and ``max_chars`` characters in all (filled in the order of a hash of the id, the first
    page of any length) and ``copies`` new layouts of each.

    Only pages with text in an article element can label themselves; others are not sampled, equal rows once. If none can though
    some page is not blank, ValueError is raised. A table without such pages gets a placeholder model, as all its texts are empty.
    """
    text_batches(pages.sparkSession)
    keyed = pages.where(F.col(html_col).rlike(r"\S")).select(md5_unit("page:", F.col(id_col)).alias("u"), F.xxhash64(html_col).alias("digest"), F.col(html_col).alias("html"))
    found = stage(keyed.mapInArrow(_first_labelled(max_pages), "u double, digest long, size long, labelled boolean"), "labelled")
    first = found.where("labelled").select("u", "digest", "size").distinct().orderBy("u", "digest").limit(max_pages)
    before = F.coalesce(F.sum("size").over(Window.orderBy("u", "digest").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # of at most max_pages rows
    picked = stage(first.withColumn("before", before).where(F.col("before") < max_chars).select("u", "digest"), "picked")
    rows = keyed.join(F.broadcast(picked), ["u", "digest"]).dropDuplicates(["u", "digest"]).collect()  # at most max_pages pages
    if not rows and not found.isEmpty():
        raise ValueError("no page has text in an article element to learn from")
    sample = [r["html"] for r in sorted(rows, key=lambda r: (r["u"], r["digest"]))]
    rng = random.Random(seed)
    real = [parse(s) for s in sample] or [parse("<article><p>a</p></article>")]
    pieces = [t for p in real for _, t, _ in p.blocks]
    laid = [parse(relaid(p, pieces, rng)) for p in real for _ in range(copies)]
    x, _ = node_features(real + laid)
    y = np.concatenate([*(node_labels(p) for p in real), *(node_labels(p, True) for p in laid)])
    return fit_boosted_trees(x[y >= 0], y[y >= 0].astype(float))


def extract(pages: DataFrame, model: dict[str, np.ndarray], id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text. Blocks are joined by a line break, white space inside one is a single space.

    Null and empty pages have an empty text; a page that is all boilerplate too. Repeated rows are extracted alike, one row
    each; an empty table gives none. Other columns are not read.
    """
    text_batches(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(model)  # trees * (2 ** depth) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = extract_batch(sent.value, [s or "" for s in b.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    out = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
