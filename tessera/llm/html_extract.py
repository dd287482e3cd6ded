"""Main-text extraction by a tree-structured graphical model over the DOM.

A page's element tree has one binary variable a node: content or not. A node
has a log-odds potential from discrete features of its own (tag class, words
of its class and id, link share, length of text, depth of lists), and each
parent-child edge a 2 x 2 potential that depends on the child's tag class.
Exact marginals come from one sum-product pass up the tree and one down. The
text blocks of nodes whose marginal is over one half are the main text.

Training. Labelled pages are (html, label) pages whose nodes get their labels
by ``labelled``: from ``data-label`` attributes where a page has them (the
seed pages below, which spell out menus, sidebars, notices, forms and comments
once each), else from its own sectioning: inside ``article`` or ``main`` is
content, save in parts that are plainly not. Pages without either say nothing.
Spark parses the labelled pages and counts (features, label) and (tag class,
parent label, child label) combinations, a few hundred rows whatever the
pages; the node weights are fitted to these counts by logistic regression.
``train_pages`` bounds the sample: a share of the pages picked by a hash of
page_id. Extraction itself covers every page and its whole html.

Parsing is one linear scan: void and raw-text elements, comments, implied end
tags and unclosed elements are handled; scripts, styles, templates, the head
and form controls never give text. An unfinished tag at the end is dropped, a
tag with a quote that is never closed is text. Places of open elements are kept
by name, so no end tag walks the whole stack, however deep a page nests.

``data-label`` marks content in the seed pages alone; in crawled pages it means
other things.

Edge cases: null and empty html give an empty text; only page_id, url and the
html column are read, so clashing names do no harm; a page without tags is one
block; repeated rows give repeated results; an empty table gives an empty
result, with the model of the seed pages alone.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import Counter
from math import exp, log1p

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

TRAIN_PAGES = 2000
SEED_SHARE = 0.3

#: Element classes of HTML (fixed values).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
SILENT = set("head script style noscript template textarea select option button svg canvas object iframe "
             "noembed noframes title audio video datalist input label math".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span "
             "strike strong sub sup time tt u var br wbr img".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
               "h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Open elements that a start tag ends, and the elements that this search stops at.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")),
        "th": (("td", "th"), ("tr", "table"))}
#: Tag classes of the model.
TAG_CLASS = {t: c for c, tags in {
    "main": "article main", "chrome": "nav header footer aside menu dialog", "form": "form fieldset",
    "heading": "h1 h2 h3 h4 h5 h6 hgroup", "prose": "p blockquote pre figcaption dd", "list": "ul ol dl",
    "item": "li dt tr td th", "root": "html body",
}.items() for t in tags.split()}
#: Words of class, id and role attributes that name a part of a page.
OUTSIDE = set("ad ads adv advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs byline "
              "comment comments consent cookie cookies copyright disclaimer dialog disqus discussion feedback footer "
              "foot form gdpr header hero legal login masthead menu menubar modal nav navbar navigation newsletter "
              "notice notices notification overlay pager pagination paywall popup popular privacy promo promoted "
              "promotion reader readers recommended related replies reply respond responses search share sharing "
              "sidebar sidebars signup skip social sponsor sponsored subscribe subscription tags teaser toolbar "
              "topbar trending warning widget widgets alert aside complementary contentinfo".split())
INSIDE = set("article articlebody body content entry main mainbody post prose story text".split())

SEED_PAGES = (
    '<html><body data-label="0"><header>News site<p>All the news of the day</p></header><nav><ul><li><a href="/">Home</a>'
    '<li><a href="/w">World</a></ul></nav><div class="notice">We use cookies. Read our policy to learn more about it.</div>'
    '<main data-label="1"><h1>A headline of the day</h1><p>The first paragraph tells what has happened, where and when it '
    'was, and who has said so, in some length.</p><p>Short one.</p><ul><li>One point of several</li></ul></main><aside>'
    '<h2>Most read</h2><p>Another story that many people have read today, with a long teaser to go with it.</p></aside>'
    '<form><p>Leave your address here to get our letter each week, with all of the stories.</p></form><section '
    'class="comments"><h2>Comments</h2><p>I have read this and do not agree at all with what the author says here.</p>'
    '<div class="comment"><p>Nor do I, to be honest with you, and I said so before.</p></div></section><footer><p>All '
    'rights reserved by the owner of this site.</p></footer></body></html>',
    '<html><body data-label="0"><div id="header">Some weblog</div><div class="menu"><a href="/a">About</a> <a href="/b">'
    'Archive</a></div><div class="wrapper"><div class="post" data-label="1"><h2>A day out</h2><p>We went out early and '
    'came back late, and saw a great many things on the way there.</p><p>It rained.</p><blockquote>Rain is good for you, '
    'as they always say.</blockquote></div><div class="sidebar" data-label="0"><h3>Links</h3><p>See these pages of our friends '
    'for more of the same kind of writing.</p></div></div><div class="ad">Buy this now, it is cheap and good for you and '
    'for all.</div><div id="footer">Contact us</div></body></html>',
    '<html><body data-label="0"><div class="cookie-banner">Cookies help us deliver. Accept all of them or some.</div>'
    '<article data-label="1"><header data-label="1"><h1>The title</h1></header><div><p>A story in a plain container that goes on '
    'for a while and has all that one needs.</p><div>Text without a paragraph of its own, long enough to matter.</div></div>'
    '<aside class="related" data-label="0"><p>Read also this other story that we think you will like a lot.</p></aside><div '
    'class="advert" data-label="0">An advert in between paragraphs of it.</div><form data-label="0"><p>Subscribe to the '
    'letter and never miss one.</p></form><table><tr><td>A cell of figures</td></tr></table><section class="comments" '
    'data-label="0"><p>A reader says that this is quite a good article to read.</p></section></article></body></html>',
)

_MARK = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)(?=[a-zA-Z])")
_NAME_END = re.compile(r"[\s/>]")
_SPECIAL = re.compile(r"[>\"']")
# a name begins where none is under way, so that each character is looked at once
_ATTR = re.compile(r"""(?<![^\s=/"'>])([^\s=/"'>]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_NAME = re.compile(r"[a-z]+")
_SPAN_ENDS = {"<!--": "-->", "<![CDATA[": "]]>"}


class _Ahead:
    """The next match of a pattern from a place on; a stretch without one is searched once."""

    def __init__(self, pattern: re.Pattern, source: str):
        self.pattern, self.source, self.low, self.high = pattern, source, 0, -1

    def __call__(self, at: int) -> int:
        if not self.low <= at <= self.high:
            m = self.pattern.search(self.source, at)
            self.low, self.high = at, m.start() if m else len(self.source)
        return self.high


def _tokens(source: str):
    """(begin, end, closing, tag, attributes) of every tag, comment and declaration; ``tag`` is None for the last two.

    A tag ends at the first ``>`` outside quotes, or with the page. One with a
    quote that is never closed is text; the quotes met on the way there are
    remembered, since any later tag that meets them is text as well. So each
    place is looked at a bounded number of times, whatever the page holds.
    Text of ``send``: where to go on, after raw text.
    """
    name_end, special, dead, at = _Ahead(_NAME_END, source), _Ahead(_SPECIAL, source), set(), 0
    size = len(source)
    while m := _MARK.search(source, at):
        begin, mark = m.start(), m[0]
        if mark[1:2] in ("!", "?"):
            end = source.find(_SPAN_ENDS.get(mark, ">"), m.end())
            at = size if end < 0 else end + len(_SPAN_ENDS.get(mark, ">"))
            yield begin, at, False, None, ""
            continue
        stop, met = name_end(m.end()), []
        end = special(stop)
        while end < size and source[end] != ">":
            met.append(end)
            close = -1 if end in dead else source.find(source[end], end + 1)
            if close < 0:
                end = -1
                break
            end = special(close + 1)
        if end < 0:
            dead.update(met)
            at = m.end()
            continue
        at = min(size, end + 1)
        onward = yield begin, at, bool(m[1]), source[m.end():stop] if end < size else None, source[stop:end]
        if onward is not None:
            at = onward
            yield None


class Page:
    """Block-level element tree of a page; node 0 is the page itself, parents come before children."""

    def __init__(self, source: str):
        self.tags, self.parents, self.attrs = ["html"], [-1], [""]
        self.chars, self.link_chars = [0], [0]
        self.blocks: list[tuple[int, str]] = []  # (node, text) in page order
        self._stack = [("html", 0, False)]  # (tag, node, silent)
        self._at = {"html": [0]}            # where each open tag stands in the stack
        self._boxes = [0]                   # where those stand that are not inline
        self._text, self._links, self._in_link = [], 0, 0
        self._parse(source)

    def _flush(self):
        if self._text:
            text = "".join(self._text)
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                node = self._stack[-1][1]
                self.blocks.append((node, text))
                self.chars[node] += len(text)
                self.link_chars[node] += min(len(text), self._links)
        self._text, self._links = [], 0

    def _say(self, text: str):
        if text and not self._stack[-1][2]:
            self._text.append(text)
            if self._in_link:
                self._links += len(text)

    def _pop(self, depth: int):
        while len(self._stack) > depth:
            tag = self._stack[-1][0]
            if tag not in INLINE:
                self._flush()
            elif tag == "a":
                self._in_link = max(0, self._in_link - 1)
            self._stack.pop()
            self._at[tag].pop()
            if tag not in INLINE:
                self._boxes.pop()

    def _push(self, tag: str, node: int, quiet: bool):
        self._at.setdefault(tag, []).append(len(self._stack))
        if tag not in INLINE:
            self._boxes.append(len(self._stack))
        self._stack.append((tag, node, quiet))

    def _last(self, tag: str) -> int:
        """Where the innermost open ``tag`` stands, 0 if none but the page does."""
        return (self._at.get(tag) or (0,))[-1]

    def _open(self, tag: str, attrs: str):
        if tag in CLOSES_P and self._last("p") and self._boxes[-1] == self._last("p"):
            self._pop(self._last("p"))
        if tag in ENDS:
            names, stops = ENDS[tag]
            stop = max(self._last(t) for t in stops)
            ended = [self._at[t][k] for t in names if (k := bisect_right(self._at.get(t, ()), stop)) < len(self._at.get(t, ()))]
            if ended:
                self._pop(min(ended))
        if tag in VOID:
            if tag in ("br", "wbr", "img", "input"):
                self._say(" " if tag != "wbr" else "")
            elif tag == "hr":
                self._flush()
            return
        if tag in ("html", "body") and len(self._stack) > 1 and self._at.get(tag):
            return
        _, node, silent = self._stack[-1]
        quiet = silent or tag in SILENT
        if tag not in INLINE:
            self._flush()
            if not quiet:
                self.tags.append(tag)
                self.parents.append(node)
                self.attrs.append(attrs)
                self.chars.append(0)
                self.link_chars.append(0)
                node = len(self.tags) - 1
        elif tag == "a":
            self._in_link += 1
        self._push(tag, node, quiet)

    def _close(self, tag: str):
        if tag == "br":
            return self._say(" ")
        i = self._last(tag)
        # an inline end tag does not reach out of its block, no end tag out of a table cell
        barrier = self._boxes[-1] if tag in INLINE else 0 if tag in ("tr", "table", "body", "html") else max(
            self._last("td") if tag != "td" else 0, self._last("th") if tag != "th" else 0)
        return self._pop(i) if i > barrier else None

    def _parse(self, source: str):
        at, tokens = 0, _tokens(source)
        for begin, end, closing, tag, attrs in tokens:
            if begin > at:
                self._say(source[at:begin])
            at = end
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                self._close(tag)
                continue
            self._open(tag, attrs)
            if tag in RAW and not attrs.endswith("/"):
                found = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
                at = found.end() if found else len(source)
                self._close(tag)
                tokens.send(at)
        rest = source[at:]
        # an unfinished tag is no text
        cut = re.compile(r"<[a-zA-Z/!?]").search(rest, rest.rfind(">") + 1)
        self._say(rest[:cut.start()] if cut else rest)
        self._pop(1)
        self._flush()

    def features(self) -> list[tuple[str, ...]]:
        """Discrete features of each node."""
        n = len(self.tags)
        chars, links, paras = self.chars[:], self.link_chars[:], [0] * n
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            chars[p] += chars[i]
            links[p] += links[i]
            paras[p] += paras[i] + (self.tags[i] == "p")
        out = []
        for i in range(n):
            tag = self.tags[i]
            kind = TAG_CLASS.get(tag, "box")
            names = _names(self.attrs[i])
            named = "out" if names & OUTSIDE else "in" if names & INSIDE else "none"
            share = links[i] / chars[i] if chars[i] else 0.0
            out.append((f"tag={kind}", f"name={named}",
                        "links=" + ("most" if share > 0.5 else "some" if share > 0.1 else "few"),
                        "chars=" + ("none" if not chars[i] else "few" if chars[i] < 40 else "more" if chars[i] < 200
                                    else "many"),
                        "paras=" + ("none" if not paras[i] else "few" if paras[i] < 3 else "many")))
        return out

    def labels(self, trusted: bool = False) -> list[int] | None:
        """1 for content, 0 for the rest, None for a page that does not say; ``data-label`` counts in ``trusted`` pages."""
        marked = trusted and any("data-label" in a for a in self.attrs)
        if not marked and not any(t in ("article", "main") for t in self.tags):
            return None
        out = []
        for i, tag in enumerate(self.tags):
            up = out[self.parents[i]] if i else 0
            if marked:
                m = re.search(r'data-label="([01])"', self.attrs[i])
                out.append(int(m[1]) if m else up)
            elif TAG_CLASS.get(tag) in ("chrome", "form") or _names(self.attrs[i]) & OUTSIDE:
                out.append(0)
            else:
                out.append(1 if tag in ("article", "main") else up)
        return out


def _names(attrs: str) -> set[str]:
    if "=" not in attrs:
        return set()
    return {w for k, a, b, c in _ATTR.findall(attrs) if k.lower() in ("class", "id", "role")
            for w in _NAME.findall((a or b or c).lower())}


def counted(source: str, trusted: bool = False) -> Counter:
    """(kind, key, label) counts of a labelled page: node features, and edges by tag class."""
    page = Page(source)
    labels, out = page.labels(trusted), Counter()
    if labels is None:
        return out
    for i, f in enumerate(page.features()):
        out["node", "|".join(f), labels[i]] += 1
        if i:
            out["edge", f"{f[0]}|{labels[page.parents[i]]}", labels[i]] += 1
    return out


def _training_rows(batches):
    for pdf in batches:
        total = Counter()
        for source in pdf["html"]:
            total.update(counted(source or ""))
        yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["kind", "key", "label", "n"])


class Model:
    """Node weights by feature and log potentials of edges by the child's tag class."""

    def __init__(self, nodes: dict[tuple[str, int], float], edges: dict[tuple[str, int], float]):
        keys = sorted({k for k, _ in nodes})
        names = sorted({f for k in keys for f in k.split("|")})
        index = {f: i for i, f in enumerate(names)}
        x = np.zeros((len(keys), len(names) + 1))
        x[:, -1] = 1
        for r, k in enumerate(keys):
            x[r, [index[f] for f in k.split("|")]] = 1
        pos = np.array([nodes.get((k, 1), 0.0) for k in keys])
        both = pos + np.array([nodes.get((k, 0), 0.0) for k in keys])
        w = np.zeros(len(names) + 1)
        for _ in range(50):  # Newton steps of ridge logistic regression on the counts
            p = 1 / (1 + np.exp(-(x @ w)))
            grad = x.T @ (pos - both * p) - w
            hess = (x * (both * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w += np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-8:
                break
        self.weights, self.bias = dict(zip(names, w[:-1].tolist())), float(w[-1])
        # log P(child | parent) with one count added to each case
        self.edges = {}
        for c in {k.split("|")[0] for k, _ in edges} | {f"tag={t}" for t in (*TAG_CLASS.values(), "box")}:
            row = [[edges.get((f"{c}|{p}", y), 0.0) + 1 for y in (0, 1)] for p in (0, 1)]
            self.edges[c] = [[float(np.log(v / sum(r))) for v in r] for r in row]

    def marginals(self, page: Page) -> list[float]:
        """P(content) of each node: messages from the leaves up, then from the root down."""
        feats, n, parents = page.features(), len(page.tags), page.parents
        weight = self.weights.get
        node = [[0.0, self.bias + sum(weight(x, 0.0) for x in f)] for f in feats]
        psi = [self.edges[f[0]] for f in feats]
        up = [[0.0, 0.0]] * n
        for i in range(n - 1, 0, -1):
            a, b = node[i]
            e = psi[i]
            up[i] = [_lse(e[0][0] + a, e[0][1] + b), _lse(e[1][0] + a, e[1][1] + b)]
            p = node[parents[i]]
            p[0] += up[i][0]
            p[1] += up[i][1]
        # node[i] now holds its own potential and all messages from below
        out, belief = [0.0] * n, [None] * n
        belief[0] = node[0]
        for i in range(n):
            if i:
                b, e = belief[parents[i]], psi[i]
                c0, c1 = b[0] - up[i][0], b[1] - up[i][1]  # the parent without this child's message
                belief[i] = [node[i][0] + _lse(c0 + e[0][0], c1 + e[1][0]), node[i][1] + _lse(c0 + e[0][1], c1 + e[1][1])]
            d = belief[i][1] - belief[i][0]
            out[i] = 1 / (1 + exp(-d)) if d > -700 else 0.0
        return out

    def text(self, source: str | None) -> str:
        page = Page(source or "")
        if not page.blocks:
            return ""
        p = self.marginals(page)
        return "\n".join(t for i, t in page.blocks if p[i] > 0.5)


def _lse(a: float, b: float) -> float:
    return a + log1p(exp(b - a)) if a > b else b + log1p(exp(a - b))


def fitted(counts: dict[tuple[str, str, int], float]) -> Model:
    """A model of the given counts and the seed pages, which weigh ``SEED_SHARE`` of all nodes."""
    seeds = Counter()
    for source in SEED_PAGES:
        seeds.update(counted(source, trusted=True))
    nodes = [sum(v for k, v in c.items() if k[0] == "node") for c in (counts, seeds)]
    weight = max(1.0, SEED_SHARE / (1 - SEED_SHARE) * nodes[0] / nodes[1])
    total = {k: counts.get(k, 0.0) + weight * seeds.get(k, 0) for k in {*counts, *seeds}}
    return Model({k[1:]: v for k, v in total.items() if k[0] == "node"},
                 {k[1:]: v for k, v in total.items() if k[0] == "edge"})


def trained(pages: DataFrame, html: str = "html", train_pages: int = TRAIN_PAGES) -> Model:
    """A model of the seed pages and of about ``train_pages`` labelled pages, picked by a hash of page_id."""
    share = min(1.0, train_pages / max(1, pages.count()))
    sample = pages.filter(F.pmod(F.xxhash64("page_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    counts = sample.select(F.col(html).cast("string").alias("html")).mapInPandas(
        _training_rows, "kind string, key string, label int, n long")
    rows = counts.groupBy("kind", "key", "label").agg(F.sum("n").alias("n")).collect()
    total = {(r.kind, r.key, r.label): float(r.n) for r in rows}
    return fitted(total)


def extracted(pages: DataFrame, html: str = "html", model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars), one row a page."""
    model = trained(pages, html) if model is None else model

    @arrow_udf("string")
    def text(sources: pa.Array) -> pa.Array:
        return pa.array((model.text(s.as_py()) for s in sources), pa.string(), size=len(sources))

    out = pages.select("page_id", "url", text(F.col(html).cast("string")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def run(spark, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
