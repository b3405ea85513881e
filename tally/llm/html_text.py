"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element and every run of text is a node with a hidden label, content or not.  A
node's features speak for its label, and parent-child potentials tie the labels along the
tree.  One pass of sum-product messages upward and one downward gives each node's marginal; runs
of text more likely content than not make the page's text.

Potentials are counts from labelled pages: pages put together from templates, whose labels are
known by construction, filled with text of a bounded sample of the given pages, and the
sampled pages that mark their article themselves.

Cases: null, empty or text-free html gives an empty text.  Broken markup is read as browsers do in
the common cases (unclosed and stray tags, missing ends, quotes in attributes, raw script and
style).  A page of any length is read whole.  Repeated pages are extracted alike.  An empty
table trains on the templates alone and gives no rows.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.common import ship, table, unit_interval

SAMPLE_PAGES = 300          # of the given pages, for training
TEMPLATE_PAGES = 1200

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp".split())
RAW_END = {tag: re.compile("</" + tag, re.I | re.A) for tag in RAW}
# never displayed: descriptions inside drawings and formulas, where "/>" ends an element; heads, and choices of forms
DESCRIPTIONS = frozenset("desc metadata annotation annotation-xml".split())
DROPPED = DESCRIPTIONS | {"head", "select", "option", "datalist"}
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr"
    " ul caption legend".split())
# an opening tag ends these elements, if one is open inside the given borders
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
}
ENDS_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
P_BORDERS = frozenset("td th table caption button html body".split())

# What words in class and id attributes hint at.
HINTS = {
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs toc pagination pager skip topnav",
    "head": "header masthead topbar logo branding banner hero",
    "foot": "footer foot copyright colophon legal bottom",
    "side": "sidebar aside widget widgets rail related recommended recommendations popular trending more",
    "ad": "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promoted promotion",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe paywall warning message",
    "comment": "comment comments disqus reply replies respond discussion commentlist responses",
    "form": "form search login signup register signin",
    "share": "share sharing social follow tweet",
    "body": "article content main post entry story body text maincontent blogpost",
}
HINT_OF = {word: hint for hint, words in HINTS.items() for word in words.split()}

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
TAG_END = re.compile(r"(?>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>")
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
# any attribute, with a value or without; a quote that stays open ends with the tag
NAME_VALUE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|$)|'([^']*)(?:'|$)|([^\s>\"']+)))?")
MAYBE_HIDDEN = re.compile("hidden|display", re.I)
NOT_DISPLAYED = re.compile(r"(?:^|;)\s*display\s*:\s*none(?![-\w])", re.I)
LABEL = re.compile(r'\sdata-label="([01])"')
WORD_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Node:
    parent: int
    tag: str                        # of the element; of the containing block for a run of text
    hints: tuple = ()
    text: str | None = None         # a run of text
    link_chars: int = 0             # of the text below, how much is linked
    chars: int = 0
    label: int | None = None        # set in training pages, inherited


@dataclass
class _Run:
    parts: list = field(default_factory=list)
    link: int = 0


def hidden(attributes: str) -> bool:
    """Whether an element is hidden by an attribute of its own; words inside other values do not count."""
    if not MAYBE_HIDDEN.search(attributes):
        return False
    values: dict[str, str] = {}
    for m in NAME_VALUE.finditer(attributes):       # the first of a name counts
        values.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return ("hidden" in values or values.get("aria-hidden", "").strip().lower() == "true"
            or NOT_DISPLAYED.search(html_lib.unescape(values.get("style", ""))) is not None)


def hints_of(attributes: str) -> tuple:
    found = set()
    for m in ATTRIBUTE.finditer(attributes):
        if m[1].lower() in ("class", "id", "role"):
            for word in WORD_PART.findall(m[2] or m[3] or m[4] or ""):
                hint = HINT_OF.get(word.lower())
                if hint:
                    found.add(hint)
    return tuple(sorted(found - {"body"} or found))       # "comment-body" is about comments


class TemplatePage(str):
    """A page whose ``data-label`` attributes are training labels; in other pages they are attributes like any."""


def parse(page: str) -> list[Node]:
    """Block elements and runs of text in page order; a node's parent comes before it."""
    labelled = isinstance(page, TemplatePage)
    nodes = [Node(-1, "html")]
    stack: list[tuple[str, int]] = [("html", 0)]       # open elements with the node that their text belongs to
    open_at: dict[str, list[int]] = defaultdict(list)   # of each tag and of "!block", the depths where one is open
    endless: set[str] = set()                           # raw tags whose end does not come again
    run, links, dropped = _Run(), 0, 0
    pos, n = 0, len(page)

    def flush():
        nonlocal run
        if run.parts:
            text = " ".join(html_lib.unescape("".join(run.parts)).split())
            if text:
                at = stack[-1][1]
                nodes.append(Node(at, nodes[at].tag, text=text, link_chars=min(run.link, len(text)), chars=len(text),
                                  label=nodes[at].label))
            run = _Run()

    def add(text: str):
        if dropped or not text:
            return
        run.parts.append(text)
        if links:
            run.link += len(text)

    def push(tag: str, node: int):
        open_at[tag].append(len(stack))
        if tag in BLOCK:
            open_at["!block"].append(len(stack))
        stack.append((tag, node))

    def close(depth: int):
        nonlocal links, dropped
        if deepest("!block") >= depth:
            flush()
        while len(stack) > depth:
            tag, _ = stack.pop()
            open_at[tag].pop()
            if tag in BLOCK:
                open_at["!block"].pop()
            links -= tag == "a"
            dropped -= tag in DROPPED or tag == "!hidden"

    def deepest(tag: str) -> int:
        """Where the innermost open element of this tag is; 0 if none is."""
        depths = open_at.get(tag)
        return depths[-1] if depths else 0

    def outermost(tags, borders) -> int | None:
        """Where the first of ``tags`` is open inside the innermost open border."""
        border = max(map(deepest, borders))
        found = None
        for tag in tags:
            depths = open_at.get(tag)
            if depths and depths[-1] > border:
                d = depths[bisect_right(depths, border)]
                found = d if found is None else min(found, d)
        return found

    def close_head():       # a head that was never closed
        if open_at.get("head"):
            close(open_at["head"][0])

    while pos < n:
        lt = page.find("<", pos)
        if lt < 0:
            add(page[pos:])
            break
        if lt > pos:
            add(page[pos:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            pos = n if end < 0 else end + 3
            continue
        if lt + 1 < n and page[lt + 1] in "!?":
            end = page.find(">", lt)
            pos = n if end < 0 else end + 1
            continue
        m = TAG.match(page, lt)
        if not m:
            add("<")
            pos = lt + 1
            continue
        tag, closing = m[2].lower(), bool(m[1])
        e = TAG_END.match(page, m.end())
        if e:
            attributes, pos = page[m.end():e.end() - 1], e.end()
        else:               # an open quote: the tag ends at the next bracket
            end = page.find(">", m.end())
            attributes, pos = page[m.end():end if end >= 0 else n], (end + 1 if end >= 0 else n)
        if closing:
            d = deepest(tag)
            if tag == "p" and outermost(("p",), P_BORDERS) is None:
                flush()
            elif d and (tag in BLOCK or deepest("!block") < d):     # an inline end tag does not reach out of its block
                close(d)
            continue
        if tag in RAW and not attributes.endswith("/"):
            end = None if tag in endless else RAW_END[tag].search(page, pos)
            if end is None:
                endless.add(tag)
                pos = n if tag in ("script", "style") else pos
                continue
            close_end = page.find(">", end.start())
            pos = n if close_end < 0 else close_end + 1
            continue
        if tag == "br" or tag == "wbr" or tag == "img":
            add(" " if tag != "wbr" else "")
            continue
        if tag in ENDS_P:
            d = outermost(("p",), P_BORDERS)
            if d is not None:
                close(d)
        if tag in CLOSES:
            d = outermost(*CLOSES[tag])
            if d is not None:
                close(d)
        if tag in VOID:
            if tag in BLOCK:
                flush()
            continue
        if tag == "body" or tag == "html":
            flush()
            if "class" in attributes or "id" in attributes:
                nodes[stack[-1][1]].hints = tuple(sorted(set(nodes[stack[-1][1]].hints) | set(hints_of(attributes))))
            close_head()
            continue
        if tag in DESCRIPTIONS and attributes.endswith("/"):
            continue
        if tag in BLOCK:
            close_head()
            flush()
            label = nodes[stack[-1][1]].label
            mark = LABEL.search(attributes) if labelled else None
            if mark:
                label = int(mark[1])
            nodes.append(Node(stack[-1][1], tag, hints_of(attributes) if "=" in attributes else (), label=label))
            push(tag, len(nodes) - 1)
        else:
            push(tag, stack[-1][1])
        if tag == "a":
            links += 1
        if tag in DROPPED:
            dropped += 1
        elif attributes and hidden(attributes):
            dropped += 1
            push("!hidden", stack[-1][1])
    flush()
    for x in reversed(nodes[1:]):
        nodes[x.parent].chars += x.chars
        nodes[x.parent].link_chars += x.link_chars
    return nodes


# -- model -----------------------------------------------------------------

SENTENCE = re.compile(r"[.!?…:;](?:\W|$)")
LENGTHS = (3, 8, 15, 30, 60, 120)


def features(node: Node) -> list[str]:
    share = node.link_chars / node.chars if node.chars else 0
    linked = "none" if share == 0 else "some" if share < 0.5 else "most"
    if node.text is None:
        size = sum(node.chars > x for x in (60, 300, 1200))
        return [f"tag {node.tag} {linked}", f"size {size} {linked}"] + ["hint " + h for h in node.hints]
    n = node.text.count(" ") + 1
    sentence = SENTENCE.search(node.text) is not None
    return [f"in {node.tag} {linked}", f"words {sum(n > x for x in LENGTHS)} {int(sentence)}"] \
        + (["sign"] if node.text[0] == "©" else [])


@dataclass
class Model:
    """Log potentials: of features by label, of the root's label, and of (parent label, child label)."""

    feature: dict
    root: tuple
    edge: tuple

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content for every node: messages up to the root, then down."""
        known = self.feature
        belief, up = [], []
        for x in nodes:
            a = b = 0.0
            for f in features(x):
                p = known.get(f)
                if p:
                    a, b = a + p[0], b + p[1]
            belief.append([a, b])
            up.append((0.0, 0.0))
        (e00, e01), (e10, e11) = self.edge
        for i in range(len(nodes) - 1, 0, -1):
            a, b = belief[i]
            m0, m1 = _log_sum(e00 + a, e01 + b), _log_sum(e10 + a, e11 + b)
            up[i] = (m0, m1)
            parent = belief[nodes[i].parent]
            parent[0] += m0
            parent[1] += m1
        belief[0][0] += self.root[0]
        belief[0][1] += self.root[1]
        for i in range(1, len(nodes)):
            a, b = belief[nodes[i].parent]
            a, b = a - up[i][0], b - up[i][1]       # the parent's belief without this child
            belief[i][0] += _log_sum(a + e00, b + e10)
            belief[i][1] += _log_sum(a + e01, b + e11)
        return [1 / (1 + math.exp(min(700.0, max(-700.0, a - b)))) for a, b in belief]

    def text(self, page: str | None) -> str:
        if not page:
            return ""
        nodes = parse(page)
        marginals = self.marginals(nodes)
        return "\n".join(x.text for x, p in zip(nodes, marginals) if x.text is not None and p > 0.5)


def _log_sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a >= b else b + math.log1p(math.exp(a - b))


def spread_labels(nodes: list[Node]) -> list[int]:
    """Labels of all nodes: runs as marked; an element is content if most text below it is."""
    chars = [[0, 0] for _ in nodes]
    for i in range(len(nodes) - 1, -1, -1):
        x = nodes[i]
        if x.text is not None:
            chars[i][x.label or 0] += len(x.text)
        if i:
            for k in (0, 1):
                chars[x.parent][k] += chars[i][k]
    out = []
    for x, (no, yes) in zip(nodes, chars):
        out.append(int(yes > no) if no + yes else (x.label or 0))
    return out


def fit(pages: list[list[Node]]) -> Model:
    """Potentials from labelled pages, with add-one smoothing."""
    counts = {0: Counter(), 1: Counter()}
    totals, edge, root = Counter(), Counter(), Counter()
    for nodes in pages:
        labels = spread_labels(nodes)
        root[labels[0]] += 1
        for x, y in zip(nodes, labels):
            kind = x.text is not None
            totals[kind, y] += 1
            counts[y].update(features(x))
            if x.parent >= 0:
                edge[labels[x.parent], y] += 1
    feature = {}
    for f in set(counts[0]) | set(counts[1]):
        kind = f.split()[0] in ("in", "words", "sign")
        feature[f] = tuple(math.log((counts[y][f] + 0.5) / (totals[kind, y] + 10)) for y in (0, 1))
    row = lambda c, keys: tuple(math.log((c[k] + 1) / (sum(c[j] for j in keys) + 2)) for k in keys)
    return Model(feature, row(root, (0, 1)), (row(edge, ((0, 0), (0, 1))), row(edge, ((1, 0), (1, 1)))))


# -- labelled pages ----------------------------------------------------------

PLAIN = ("The first line of a plain page. It goes on for a while, and then it ends.", "A short one.",
         "Another paragraph follows here; it is as long as most are, with commas, and with a full stop at the end.")


class Templates:
    """Pages of several common layouts with known labels (``data-label``), filled from ``texts``."""

    def __init__(self, texts: list[str], seed: int = 1):
        self.texts, self.rng = texts or list(PLAIN), random.Random(seed)

    def words(self, least: int, most: int) -> str:
        parts, n = [], self.rng.randint(least, most)
        while len(parts) < n:
            parts += self.rng.choice(self.texts).split()
        return html_lib.escape(" ".join(parts[:n]))

    def sentence(self, least: int, most: int) -> str:
        return self.words(least, most).rstrip(".,") + ("." if self.rng.random() < 0.9 else "")

    def links(self, n: int, sep: str = "") -> str:
        return sep.join(f'<a href="/x">{self.words(1, 3)}</a>' for _ in range(n))

    def box(self, tags: str, classes: str, inner: str, label: int | None = 0) -> str:
        tag = self.rng.choice(tags.split())
        name = self.rng.choice(classes.split()) if classes else ""
        mark = f' data-label="{label}"' if label is not None else ""
        key = self.rng.choice(["class", "class", "id"])
        return f"<{tag}{mark}" + (f' {key}="{name}"' if name and self.rng.random() < 0.85 else "") + f">{inner}</{tag}>"

    def menu(self) -> str:
        n = self.rng.randint(3, 9)
        items = "".join(f'<li><a href="/{i}">{self.words(1, 2)}</a></li>' for i in range(n))
        inner = f"<ul>{items}</ul>" if self.rng.random() < 0.7 else self.links(n, " | ")
        return self.box("nav nav nav div ul", "nav menu navbar navigation breadcrumb main-menu", inner)

    def boilerplate(self) -> str:
        r = self.rng
        kind = r.choice(["menu", "ad", "ad", "side", "notice", "comment", "form", "share", "related"])
        if kind == "menu":
            return self.menu()
        if kind == "ad":
            return self.box("div div aside section p", "ad ads advert advertisement sponsored promo", self.sentence(3, 25))
        if kind == "side":
            inner = f"<h3>{self.words(1, 4)}</h3>" + r.choice([f"<p>{self.sentence(5, 30)}</p>", f"<ul><li>{self.links(4, '</li><li>')}</li></ul>"])
            return self.box("aside aside div section", "sidebar side-bar widget right-rail", inner)
        if kind == "notice":
            inner = f"<p>{self.sentence(6, 25)}</p>" + r.choice(["", "<button>OK</button>", self.links(1)])
            return self.box("div section aside dialog", "cookie-banner cookie-notice consent notice alert newsletter popup", inner)
        if kind == "comment":
            one = lambda: self.box("div li article", "comment reply comment-body", f"<p>{self.words(1, 2)}</p><p>{self.sentence(4, 40)}</p>")
            inner = f"<h3>{self.words(1, 3)}</h3>" + "".join(one() for _ in range(r.randint(1, 5)))
            return self.box("section div ol", "comments comment-list discussion disqus responses", inner)
        if kind == "form":
            return self.box("form form div", "search login signup subscribe-form", f"<p>{self.sentence(2, 12)}</p><label>{self.words(1, 2)}</label><input name=q><button>Go</button>")
        if kind == "share":
            return self.box("div ul", "share social follow-us", self.links(r.randint(2, 5), " "))
        return self.box("div section aside", "related recommended more popular", f"<h4>{self.words(1, 3)}</h4><ul><li>{self.links(3, '</li><li>')}</li></ul>")

    def paragraph(self) -> str:
        r = self.rng
        x = r.random()
        text = self.sentence(1, 12) if r.random() < 0.3 else self.sentence(10, 90)
        if x < 0.75:
            if r.random() < 0.15:
                text = text.replace(" ", f" <a href=/y>{self.words(1, 3)}</a> ", 1)
            return r.choice([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>"])
        if x < 0.82:
            return f"<h2>{self.words(1, 8)}</h2>"
        if x < 0.9:
            return "<ul>" + "".join(f"<li>{self.words(2, 15)}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
        if x < 0.95:
            return f"<blockquote><p>{text}</p></blockquote>"
        return f"<table><tr><td>{self.words(1, 3)}<td>{self.words(1, 5)}</table>"

    def page(self) -> str:
        r = self.rng
        body = f"<h1>{self.words(2, 10)}</h1>" + "".join(self.paragraph() for _ in range(r.randint(1, 12)))
        if r.random() < 0.35:       # boilerplate in the middle of the article
            cut = body.rfind("<p>")
            if cut > 0:
                body = body[:cut] + self.boilerplate() + body[cut:]
        if r.random() < 0.25:
            body += self.boilerplate()
        article = self.box("article article article main div section", "article content post entry story main post-content", body, 1)
        if r.random() < 0.3:
            article = self.box("main div", "main content page wrapper container", article + (self.boilerplate() if r.random() < 0.5 else ""), 0)
        head = self.box("header header div", "header masthead site-header banner", r.choice(["", f"<p>{self.words(1, 5)}</p>", f"<h2>{self.words(1, 4)}</h2>"]) + r.choice(["", self.menu()])) if r.random() < 0.6 else self.menu()
        foot = self.box("footer footer div", "footer site-footer copyright", r.choice(["", "<p>"]) + "&copy; " + self.sentence(2, 30))
        before = "".join(self.boilerplate() for _ in range(r.randint(0, 2)))
        after = "".join(self.boilerplate() for _ in range(r.randint(0, 3)))
        return TemplatePage(
            f'<html><head><title>x</title></head><body data-label="0">{head}{before}{article}{after}{foot}</body></html>')


def own_labels(nodes: list[Node]) -> list[Node] | None:
    """Label a page by its own markup, if it has one article element: what that holds is content."""
    articles = [i for i, x in enumerate(nodes) if x.tag in ("article", "main") and x.text is None]
    if len(articles) != 1:
        return None
    inside = {articles[0]}
    for i in range(articles[0] + 1, len(nodes)):
        x = nodes[i]
        if x.parent in inside and not (set(x.hints) & {"ad", "comment", "notice", "share", "nav"}) \
                and x.tag not in ("nav", "aside", "footer", "form"):
            inside.add(i)
    for i, x in enumerate(nodes):
        x.label = int(i in inside)
    return nodes


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Model:
    """Fit the model; reads at most ``sample_pages`` pages of moderate length, chosen by a hash."""
    fit_for_it = pages.filter(F.length("html").between(1, 100_000)).select("html")
    # about sample_pages rows by a hash, then at most that many: tasks send no more than is needed
    share = min(1.0, 1.2 * sample_pages / max(1, fit_for_it.count()))
    sample = fit_for_it.filter(unit_interval(F.lit("pages"), F.col("html")) <= share).limit(sample_pages).collect()
    parsed = [parse(r["html"]) for r in sample]
    marked = [own for own in map(own_labels, parsed) if own]
    templates = Templates([x.text for nodes in marked for x in nodes if x.text is not None and x.label])
    return fit([parse(templates.page()) for _ in range(TEMPLATE_PAGES)] + marked)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """Add ``text`` and ``n_chars`` to pages with an ``html`` column (which is left out; other columns pass through)."""
    pages = pages.drop("text", "n_chars")
    others = [c for c in pages.columns if c != "html"]
    pages = pages.select(*others, "html")
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def batches(it):
        own = shared.value
        for batch in it:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [own.text(x.as_py()) for x in part.column(len(others))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=[*others, "text", "n_chars"])

    schema = T.StructType([f for f in pages.schema.fields if f.name != "html"]
                          + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return ship(pages).mapInArrow(batches, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: the main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, train(pages))
