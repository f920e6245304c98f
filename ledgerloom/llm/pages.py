"""Main text of HTML pages by gradient-boosted trees over DOM nodes with hierarchical decoding.

A page is parsed to its block nodes. Each node has features of its subtree (text, link and tag density),
its attribute tokens and its ancestors', its depth and its siblings. Trees boosted on the logistic loss
give the log odds that a node belongs to the article. Decoding keeps the connected set of nodes from the
root with the greatest sum of log odds, so a kept node never lies in a dropped one.

Training labels come from the pages themselves: on a bounded sample of pages (`SAMPLE`, whole pages),
nodes inside an article or main element are positive unless they or a node between say otherwise.
Copies of these pages, in which blocks of further kinds are put in, the article's element is renamed or
names are taken away, teach the model to do without a particular template.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_texts, thinned

#: Training pages, at most.
SAMPLE = 120
TREES, DEPTH, RATE, BINS = 60, 4, 0.3, 32

# Element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe title textarea".split())
# Their contents are not text of the page either, but they end with the block around them.
DROPPED = frozenset("template svg select object".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul caption button label".split()
)
CLOSES_P = BLOCKS - frozenset(("html", "body", "button", "label", "option", "legend", "td", "th", "tr", "tbody", "thead", "tfoot"))
SIBLING_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset(("ul", "ol", "dl", "table", "select", "menu"))

# Words in names of elements, classes, ids and roles.
GROUPS = {
    "main": "article main content post entry story body text maincontent articlebody",
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs toc pagination pager tabs skip",
    "edge": "footer header banner masthead contentinfo copyright topbar bottom logo",
    "side": "aside sidebar side rail widget complementary related recommended popular share social tags trending more",
    "advert": "ad ads advert advertisement adbox adslot sponsor sponsored promo promotion banner dfp outbrain taboola",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay dialog warning disclaimer subscribe newsletter paywall",
    "comment": "comment comments commentlist respond reply replies discussion disqus reviews feedback",
    "form": "form search login signup register input fieldset button field",
}
LEXICON = {word: i for i, group in enumerate(GROUPS.values()) for word in group.split()}
BAD_GROUPS = frozenset(range(1, len(GROUPS)))
TAG_KINDS = ("p", "h1", "h2", "h3", "li", "ul", "div", "section", "table", "td", "blockquote", "pre", "body")

PIECE = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[!?][^>]*>|[^<]+|<""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """Block nodes in page order; `texts` are (node, text) of text blocks in page order."""

    tags: list[str]
    parents: list[int]
    groups: list[frozenset]
    links: list[int]
    inline: list[int]
    texts: list[tuple[int, str]]


def name_groups(tag: str, attributes: str) -> frozenset:
    """Groups of the words in an element's name, class, id and role."""
    found = {LEXICON[tag]} if tag in LEXICON else set()
    if "=" in attributes:
        for m in ATTRIBUTE.finditer(attributes):
            if m[1].lower() in ("class", "id", "role"):
                for part in NAME_PART.findall(m[2] or m[3] or m[4] or ""):
                    if part.lower() in LEXICON:
                        found.add(LEXICON[part.lower()])
    return frozenset(found)


class OpenElements:
    """The stack of open elements as (name, block node, whether its text is dropped), and where each name is open."""

    def __init__(self) -> None:
        self.items: list[tuple[str, int, bool]] = [("html", 0, False)]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]

    @property
    def node(self) -> int:
        return self.items[-1][1]

    @property
    def dropped(self) -> bool:
        return self.items[-1][2]

    def push(self, tag: str, node: int, dropped: bool) -> None:
        self.places.setdefault(tag, []).append(len(self.items))
        if tag in BLOCKS:
            self.blocks.append(len(self.items))
        self.items.append((tag, node, dropped))

    def last(self, tags: Iterable[str]) -> int:
        """The place of the innermost open element of some names; 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def cut(self, k: int) -> list[tuple[str, int, bool]]:
        """Close the elements from place k on, and return them."""
        gone = self.items[k:]
        for tag, *_ in gone:
            self.places[tag].pop()
        while self.blocks[-1] >= k:
            self.blocks.pop()
        del self.items[k:]
        return gone


def parse(source: str) -> Page:
    """The block nodes of a page; end tags that are missing or stray are tolerated.

    Raw text elements run to their end tag or to the end of the page. Other elements whose contents are
    dropped end with the block around them at the latest, and a block inside an svg ends the svg. Time is
    linear in the length: an end tag without an open element is known by the name's places.
    """
    page = Page(["html"], [-1], [frozenset()], [0], [0], [])
    stack = OpenElements()
    words: list[str] = []
    in_link = 0
    at, end = 0, len(source)
    last_tag = source.rfind(">")

    def flush() -> None:
        if words:
            text = " ".join("".join(words).split())
            if text:
                page.texts.append((stack.node, text))
            words.clear()

    def close(k: int) -> None:
        nonlocal in_link
        under = stack.items[k - 1][1]
        if any(node != under for _, node, _ in stack.items[k:]):
            flush()
        in_link -= sum(tag == "a" for tag, *_ in stack.cut(k))

    while at < end:
        m = PIECE.match(source, at) if at <= last_tag else None
        piece = m[0] if m else source[at:]
        at += len(piece)
        tag = m[2] if m else None
        if tag is None:
            if not m or piece[0] != "<" or piece == "<":
                if not stack.dropped:
                    text = html.unescape(piece)
                    words.append(text)
                    if in_link:
                        page.links[stack.node] += len(text.strip())
            continue
        tag = tag.lower()
        if m[1]:
            if k := stack.last((tag,)):
                close(k)
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                stop = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(source, at)
                at = stop.end() if stop else end
            continue
        if tag == "head" or tag == "html":
            continue
        if tag in VOID:
            if (tag == "br" or tag == "hr") and not stack.dropped:
                if tag == "hr":
                    flush()
                words.append(" ")
            continue
        if tag in DROPPED:
            if not m[3].endswith("/"):
                stack.push(tag, stack.node, True)
            continue
        if tag in BLOCKS and stack.dropped and (k := stack.last(("svg",))) > stack.blocks[-1]:
            close(k)
        if tag in CLOSES_P or tag in SIBLING_CLOSES:
            shut = SIBLING_CLOSES.get(tag, ()) + (("p",) if tag in CLOSES_P else ())
            if "p" in shut:
                k, stop = stack.last(shut), stack.last(SCOPE)
            else:
                k, stop = stack.last(shut), 0
                stop = stack.blocks[-1] if stack.blocks[-1] != k else 0
            if k > stop:
                close(k)
        if stack.dropped:
            stack.push(tag, stack.node, True)
            in_link += tag == "a"
        elif tag in BLOCKS:
            flush()
            page.tags.append(tag)
            page.parents.append(stack.node)
            page.groups.append(name_groups(tag, m[3]))
            page.links.append(0)
            page.inline.append(0)
            stack.push(tag, len(page.tags) - 1, False)
        else:
            page.inline[stack.node] += 1
            in_link += tag == "a"
            stack.push(tag, stack.node, False)
    flush()
    return page


def features(page: Page, names: bool = True) -> np.ndarray:
    """A row per node; without `names`, the features of element and attribute names are blank."""
    n = len(page.tags)
    own, ends, count = np.zeros(n), np.zeros(n), np.zeros(n)
    for node, text in page.texts:
        own[node] += len(text)
        ends[node] += text.count(".") + text.count(",") + text.count("?") + text.count("!")
        count[node] += 1
    links, inline, nodes = np.array(page.links, float), np.array(page.inline, float), np.ones(n)
    text, paragraphs = own.copy(), np.array([float(t == "p") for t in page.tags])
    parents = page.parents
    depth, children = np.zeros(n), np.zeros(n)
    for i in range(n - 1, 0, -1):
        p = parents[i]
        for a in (text, links, inline, nodes, ends, count, paragraphs):
            a[p] += a[i]
        children[p] += 1
    number, same, before = np.zeros(n), np.zeros(n), np.zeros(n)
    seen: dict[int, int] = {}
    kinds: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        p = parents[i]
        depth[i] = depth[p] + 1
        number[i] = seen[p] = seen.get(p, 0) + 1
        kinds[p, page.tags[i]] = kinds.get((p, page.tags[i]), 0) + 1
        before[i] = before[i - 1] + own[i - 1]
    for i in range(1, n):
        same[i] = kinds[parents[i], page.tags[i]]
    above = [frozenset()] * n
    for i in range(1, n):
        above[i] = above[parents[i]] | page.groups[i]
    total = max(1.0, text[0])
    up = np.maximum(0, np.array(parents))
    density = links / np.maximum(1.0, text)
    columns = [
        np.log1p(text), text / total, density, np.log1p(text) - np.log1p(nodes + inline), ends / np.maximum(1.0, text), np.log1p(own),
        np.log1p(count), np.log1p(paragraphs), depth, np.log1p(children), number / np.maximum(1.0, children[up]), np.log1p(same),
        same / np.maximum(1.0, children[up]), before / total, density[up], text[up] / total, np.log1p(nodes),
    ]
    for kind in TAG_KINDS:
        columns.append(np.array([float(t == kind) for t in page.tags]))
    for g in range(len(GROUPS)):
        columns.append(np.array([float(names and g in x) for x in page.groups]))
        columns.append(np.array([float(names and g in x) for x in above]))
    return np.stack(columns, axis=1)


def weak_labels(page: Page) -> np.ndarray:
    """1 for nodes in an article or main element outside nodes of another role, and for what they lie in; else 0."""
    n = len(page.tags)
    inside, label = np.zeros(n, bool), np.zeros(n)
    for i in range(1, n):
        if page.groups[i] & BAD_GROUPS:
            continue
        inside[i] = inside[page.parents[i]] or page.tags[i] in ("article", "main") or 0 in page.groups[i]
        label[i] = inside[i]
    for i in range(n - 1, 0, -1):
        if label[i]:
            label[page.parents[i]] = 1
    label[0] = 1
    return label


@dataclass
class Forest:
    """Boosted trees of equal depth: split feature and bound of each inner node, values of the leaves."""

    base: float
    feature: np.ndarray
    bound: np.ndarray
    value: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, b, v in zip(self.feature, self.bound, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > b[at])
            out += v[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, rate: float = RATE, smooth: float = 1.0) -> Forest:
    """Gradient boosting on the logistic loss with second-order splits over at most BINS bins a feature."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    base = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    score = np.full(n, base)
    feature, bound, value = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(n, np.int64)
        f_tree, b_tree = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
        for level in range(DEPTH):
            first, wide = 2**level - 1, 2**level
            slot = at - first
            gain, choice = np.zeros(wide), [(0, np.inf)] * wide
            for f in range(width):
                key = slot * (BINS + 1) + binned[:, f]
                gs = np.bincount(key, g, wide * (BINS + 1)).reshape(wide, -1)
                hs = np.bincount(key, h, wide * (BINS + 1)).reshape(wide, -1)
                gl, hl = np.cumsum(gs, axis=1), np.cumsum(hs, axis=1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                better = gl**2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth) - gt**2 / (ht + smooth)
                better = better[:, : len(cuts[f])]
                if not better.shape[1]:
                    continue
                best = better.argmax(axis=1)
                for s in range(wide):
                    if better[s, best[s]] > gain[s] + 1e-9:
                        gain[s], choice[s] = better[s, best[s]], (f, float(cuts[f][best[s]]))
            for s, (f, b) in enumerate(choice):
                f_tree[first + s], b_tree[first + s] = f, b
            at = 2 * at + 1 + (x[np.arange(n), f_tree[at]] > b_tree[at])
        leaf = at - (2**DEPTH - 1)
        v = rate * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + smooth)
        score += v[leaf]
        feature.append(f_tree)
        bound.append(b_tree)
        value.append(v)
    return Forest(base, np.array(feature), np.array(bound), np.array(value))


def decode_tree(parents: list[int], log_odds: np.ndarray) -> np.ndarray:
    """The nodes of the best connected set from the root: a node is kept only with its parent."""
    n = len(parents)
    best = log_odds.copy()
    best[0] = 0.0
    for i in range(n - 1, 0, -1):
        if best[i] > 0:
            best[parents[i]] += best[i]
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = best[i] > 0 and kept[parents[i]]
    return kept


def main_text(page: Page, log_odds: np.ndarray) -> str:
    kept = decode_tree(page.parents, log_odds)
    return "\n\n".join(text for node, text in page.texts if kept[node])


INSERTS = (
    '<aside class="sidebar"><h3>{a}</h3><ul><li><a href="#">{b}</a></li><li><a href="#">{c}</a></li></ul><p>{d}</p></aside>',
    '<div class="sidebar widget"><h3>{a}</h3><p>{d}</p></div>',
    '<section id="comments" class="comments"><h3>{a}</h3><div class="comment"><p>{d}</p></div><div class="comment"><p>{e}</p></div></section>',
    '<ol class="commentlist"><li>{d}</li><li>{e}</li></ol>',
    '<div class="comment"><p>{d}</p><p>{e}</p></div>',
    '<form action="/s"><label>{a}</label><button>{b}</button><p>{c}</p></form>',
    '<div class="cookie-notice"><p>{d}</p><button>{b}</button></div>',
    '<div role="alert" class="notice">{d}</div>',
    '<div class="newsletter-signup"><p>{d}</p></div>',
    '<header class="site-header"><p>{a}</p><ul class="menu"><li><a href="#">{b}</a></li><li><a href="#">{c}</a></li></ul></header>',
    '<div class="banner header"><a href="#">{a}</a><p>{c}</p></div>',
    '<div class="advert"><p>{d}</p></div>',
    '<div class="ad">{d}</div>',
    '<div class="sponsored promo"><a href="#">{b}</a><p>{e}</p></div>',
    '<div class="related"><h3>{a}</h3><ul><li><a href="#">{b}</a></li><li><a href="#">{c}</a></li></ul></div>',
    '<div class="share"><a href="#">{b}</a> <a href="#">{c}</a></div>',
    '<nav class="breadcrumbs"><a href="#">{b}</a> <a href="#">{c}</a></nav>',
    '<div class="footer"><p>{d}</p></div>',
)
OPENINGS = ('article', 'main', 'div class="content"', 'div id="main-content"', 'section class="post"', 'div class="entry-content"', 'main role="main"')
# An article or main element, or a name of the `main` group.
SAYS_WHERE = r"(?i)<(article|main)[\s>]|<[a-z]+\s[^>]*(class|id|role)\s*=\s*[\"']?[^\"'>]*(article|main|content|post|entry|story|maincontent|articlebody)"
LAYOUT = re.compile(r"(?s)(<article\b[^>]*>)(.*)(</article>)")


def variants(source: str, rng: random.Random) -> list[str]:
    """A training page and copies of it with inserted blocks and another element around the article."""
    out = [source]
    m = LAYOUT.search(source)
    if not m:
        return out
    words = re.sub(r"<[^>]*>|&\w+;", " ", m[2]).split() or ["text"]

    def some(most: int) -> str:
        start = rng.randrange(len(words))
        return html.escape(" ".join(words[start : start + rng.randrange(1, most)]) or words[0])

    for k in range(5):
        opening = rng.choice(OPENINGS)
        # The last copy is a very short article.
        body = m[2] if k < 4 else f"<h1>{some(3)}</h1>" + f"<p>{some(4)}</p>" * rng.randrange(1, 3)
        blocks = [b.format(a=some(5), b=some(4), c=some(4), d=some(80), e=some(40)) for b in rng.sample(INSERTS, 5)]
        cut = body.rfind("<p>") if rng.random() < 0.5 else -1
        if cut > 0:
            body = body[:cut] + blocks[0] + body[cut:]
        inner = f"<{opening}>{body}{blocks[1] if rng.random() < 0.5 else ''}</{opening.split()[0]}>"
        if rng.random() < 0.3:
            inner = f'<div class="wrapper">{inner}</div>'
        if rng.random() < 0.3:
            inner = re.sub(r"</p>", "", inner, count=1)
        extra = re.sub("<p>", rng.choice(("<p>", "<blockquote>", "<h2>")), inner, count=1) if rng.random() < 0.2 else inner
        if k == 4:
            out.append(source[: m.start()] + f"{m[1]}{body}{m[3]}" + source[m.end() :])
        out.append(source[: m.start()] + blocks[2] + extra + blocks[3] + blocks[4] + source[m.end() :])
    return out


# Page frames for tables in which no page says where its article is.
CHROME = (
    '<div class="menu"><a href="#">{a}</a> <a href="#">{b}</a> <a href="#">{c}</a></div>',
    '<ul class="navigation"><li><a href="#">{b}</a></li><li><a href="#">{c}</a></li></ul>',
    '<nav><a href="#">{a}</a> <a href="#">{c}</a></nav>',
    '<div role="navigation"><a href="#">{a}</a> <a href="#">{b}</a></div>',
    '<div role="contentinfo">{b}</div>',
    '<div role="banner">{a}</div>',
    '<div id="footer">{c}</div>',
    '<footer><p>{b}</p></footer>',
)
PLAIN_OPENINGS = (*OPENINGS, "div", 'div role="main"', 'div id="content"', "section", 'div class="story-body"', "td")


def built_in(rng: random.Random, many: int = 320) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Features and labels of invented pages: the frames and inserts above around plain paragraphs.

    A page is labelled with its text in an article element and learnt with another element in its place.
    """
    words = [w for group in GROUPS.values() for w in group.split()] + [f"w{i}" for i in range(400)]

    def some(most: int) -> str:
        return " ".join(rng.choices(words, k=rng.randrange(1, most)))

    x, y = [], []
    for k in range(many):
        parts = rng.sample(CHROME + INSERTS, 0 if k % 8 == 0 else rng.randrange(1, 6))
        blocks = [b.format(a=some(5), b=some(4), c=some(4), d=some(80), e=some(40)) for b in parts]
        cut = rng.randrange(len(blocks) + 1)
        most = rng.choice((3, 20, 60))
        tags = rng.choices(("p", "p", "p", "h2", "blockquote", "li", "div"), k=rng.randrange(1, 9))
        body = (f"<h1>{some(8)}</h1>" if rng.random() < 0.6 else "") + "".join(f"<{t}>{some(most)}{rng.choice(('', '.', f', {some(20)}.'))}</{t}>" for t in tags)
        if k % 8 == 4:
            body = some(40)

        def page(opening: str, before: list[str] = blocks[:cut], after: list[str] = blocks[cut:], inner: str = body) -> Page:
            return parse(f"<body>{''.join(before)}<{opening}>{inner}</{opening.split()[0]}>{''.join(after)}</body>")

        x.append(features(page(rng.choice(PLAIN_OPENINGS))))
        y.append(weak_labels(page("article")))
    return x, y


def train(pages: DataFrame, sample: int = SAMPLE) -> Forest:
    """Boosted trees on at most `sample` pages whose elements or names say where the article is, fixed by
    the hash of page_id; on built-in layouts where no page does."""
    place = F.xxhash64("page_id", "html")
    able = pages.where(F.col("html").rlike(SAYS_WHERE)).select("html", place.alias("place"))
    fit = thinned(able, able.count(), sample, "place").orderBy("place", "html").limit(sample)
    rng = random.Random(11)
    x, y = [], []
    for row in fit.collect():
        for k, source in enumerate(variants(row.html, rng)):
            page = parse(source)
            label = weak_labels(page)
            x.append(features(page))
            y.append(label)
            if k == 0:
                x.append(features(page, names=False))
                y.append(label)
    if not x or not np.concatenate(y)[np.concatenate([np.arange(len(v)) for v in y]) > 0].any():
        x, y = built_in(rng)
    return boost(np.concatenate(x), np.concatenate(y))


def extract(pages: DataFrame, forest: Forest | None = None) -> DataFrame:
    """Per page: page_id, url, text (blocks joined by a blank line; empty if none), n_chars (code points).

    A null or empty html, or one without text, gives an empty text. If no page of the table says where its
    article is and no `forest` is given, the trees learn from built-in layouts. Text directly in the body
    is kept. Very long pages are read whole, in time linear in their length. Rows that repeat a page_id are
    pages of their own, equal ones with equal texts; url may be null; an empty table gives no rows; only
    page_id, url and html are read, so other columns cannot clash.
    """
    forest = forest or train(pages)

    def work(rows: dict[str, list]) -> dict[str, list]:
        parsed = [parse(x) if x else None for x in rows["html"]]
        full = [p for p in parsed if p is not None]
        sizes = np.cumsum([0] + [len(p.tags) for p in full])
        if not full:
            odds = np.ones(sizes[-1])
        else:
            odds = forest.log_odds(np.concatenate([features(p) for p in full]))
        texts, k = [], 0
        for p in parsed:
            if p is None:
                texts.append("")
            else:
                texts.append(main_text(p, odds[sizes[k] : sizes[k + 1]]))
                k += 1
        return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    def setup() -> Callable[[dict[str, list]], dict[str, list]]:
        return work

    return map_texts(pages, ["page_id", "url", "html"], "html", "page_id long, url string, text string, n_chars long", work=dict, setup=setup)
