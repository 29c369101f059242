"""Main-text extraction: boosted trees over DOM nodes, decoded along the tree.

*Features* of every element: its kind of tag, the words of its class, id and
role, what it inherits from its ancestors, depth, the text, links and tags of
its subtree, and how it compares with its siblings.

*Fitting.*  A sample of at most SAMPLE pages (the first by hash of their id)
is labelled by its own semantic markup: what lies in ``article`` or ``main``
and in nothing that page furniture is made of is content.  Each sampled page
is also rendered anew in a few other templates, with its own texts as
article, menus, headers, footers, sidebars, notices, adverts, forms and
comments, under varying tags and names, so the trees learn layouts that
the sample lacks.  Without any labelled content in the sample, the trees are
replaced by the labelling rule.

*Decoding.*  A plain element (no class, id or role) says little by itself: an
inline one or a link goes with its parent, and half of the log-odds of a
paragraph, heading, list or table are its parent's.  An element can only be kept within kept ancestors.  Of all
such choices the one with the greatest sum of log-odds is taken, by dynamic
programming from the leaves up, so no block is kept inside a dropped
container or the other way round.  Where no text is kept, the page's own
markup decides: its article, or without one what isn't in page furniture.
Text straight in body, with the inline elements in it, is an element of its
own up to the next block (``dom.LOOSE``).  The trees have no pages to learn it
from: it is content, with the plain paragraphs beside it, unless the page has
an article or main, keeps more text in other elements, or it is mostly links.

*Text.*  Text runs of kept elements, by block; references decoded, white
space made one blank, blocks joined by newlines.

Cases: a null or empty page, and one without text, give an empty text; a page
without any element is its own text; null ids and urls stay null; repeated
rows each get their row; broken markup is read as far as it goes; an empty
table gives no rows; other columns are ignored."""

from __future__ import annotations

import random
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, boosting, common, dom

#: Pages that the trees are fitted on, at most.
SAMPLE = 300
#: Templates that each of them is rendered in.
VARIANTS = 4
#: Pages that are scored together.
PAGES = 256

_KINDS = {
    "nav": "nav menu", "header": "header", "footer": "footer", "aside": "aside dialog", "form": "form fieldset",
    "article": "article main", "heading": "h1 h2 h3 h4 h5 h6 hgroup", "para": "p pre blockquote figcaption " + dom.LOOSE,
    "list": "ul ol li dl dt dd", "table": "table tbody thead tr td th", "inline": " ".join(sorted(dom.INLINE - {"a"})), "link": "a",
    "section": "div section center"}
_KIND = {t: i for i, (_, ts) in enumerate(_KINDS.items()) for t in ts.split()}
_PLAIN = [list(_KINDS).index(k) for k in ("heading", "para", "list", "table")]
_RUNNING = [list(_KINDS).index(k) for k in ("inline", "link")]
_INHERITED = [list(_KINDS).index(k) for k in ("nav", "header", "footer", "aside", "form", "article", "link")]

# Words of class, id and role names, by what they say.
_WORDS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar tabs pager pagination",
    "header": "header masthead topbar banner logo branding",
    "footer": "footer foot copyright legal contentinfo colophon",
    "side": "sidebar side aside rail related recommended widget complementary more",
    "notice": "notice cookie cookies consent alert popup modal overlay newsletter gdpr paywall dialog",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion",
    "comment": "comment comments disqus reply replies respond discussion feedback",
    "share": "share sharing social tags tagcloud meta byline",
    "form": "form login signin signup search subscribe input",
    "content": "article content post entry story main body text prose page"}
_WORD = {w: i for i, ws in enumerate(_WORDS.values()) for w in ws.split()}
_CONTENT = len(_WORDS) - 1
_HIDDEN = len(_WORDS)
_SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")


def _flags(raw: str) -> int:
    """Bits of what an element's attributes say."""
    if not raw.strip(" /"):
        return 0
    a = dom.attributes(raw)
    out = 0
    for name in ("class", "id", "role"):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", a.get(name, "")).lower()
        for w in re.split(r"[^a-z]+", value):
            if w in _WORD:
                out |= 1 << _WORD[w]
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", ""):
        out |= 1 << _HIDDEN
    return out


class Pages:
    """Some pages' elements, end to end, as arrays."""

    def __init__(self, htmls: list[str | None]):
        self.pages = [dom.Page(h or "") for h in htmls]
        known: dict[str, int] = {}
        size = [len(p.tag) for p in self.pages]
        self.first = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        base = np.repeat(self.first[:-1], size)
        self.page = np.repeat(np.arange(len(size)), size)
        self.tags = [t for p in self.pages for t in p.tag]
        self.raw = [a for p in self.pages for a in p.attrs]
        self.flags = np.array([known[a] if a in known else known.setdefault(a, _flags(a)) for a in self.raw], np.int64)
        self.kind = np.array([_KIND.get(t, -1) for t in self.tags])
        self.unseen = np.array([t in dom.UNSEEN for t in self.tags])
        cat = lambda name: np.array([x for p in self.pages for x in getattr(p, name)], np.int64)
        self.depth = cat("depth")
        parent = cat("parent")
        self.parent = np.where(parent < 0, np.arange(len(parent)), parent + base)
        self.end = cat("end") + base
        self.root = parent < 0
        self.frame = self.root | np.array([t in ("html", "body") for t in self.tags])
        self.loose = np.array([t == dom.LOOSE for t in self.tags])
        self.own = np.zeros(len(self.tags))
        self.commas = np.zeros(len(self.tags))
        for p, f in zip(self.pages, self.first):
            for e, text, _ in p.runs:
                self.own[f + e] += len(text) - text.count(" ") - text.count("\n")
                self.commas[f + e] += text.count(",") + text.count(".")
        order = np.argsort(self.depth, kind="stable")
        self.levels = np.split(order, np.searchsorted(self.depth[order], np.arange(1, int(self.depth.max(initial=0)) + 1)))[1:]
        self.unseen = self.down(self.unseen)
        self.own[self.unseen] = 0

    def down(self, x: np.ndarray) -> np.ndarray:
        """x or that of any ancestor (bitwise)."""
        x = x.copy()
        for at in self.levels:
            x[at] |= x[self.parent[at]]
        return x

    def subtree(self, x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(x)])
        return total[self.end] - total[np.arange(len(x))]

    def features(self) -> np.ndarray:
        n = len(self.tags)
        kinds = np.zeros((n, len(_KINDS)), np.int64)
        known = self.kind >= 0
        kinds[np.flatnonzero(known), self.kind[known]] = 1
        bits = (self.flags[:, None] >> np.arange(_HIDDEN + 1)) & 1
        above = np.hstack([kinds[:, _INHERITED], bits])
        above = np.where(self.root[:, None], above, self.down(above)[self.parent])
        text = self.subtree(self.own)
        links = self.subtree(np.where(self.down(self.kind == _KIND["a"]), self.own, 0))
        tags = (self.end - np.arange(n)).astype(float)
        whole = text[self.first[:-1]][self.page]
        started = np.concatenate([[0], np.cumsum(self.own)])[np.arange(n)]
        started = started - started[self.first[:-1]][self.page]
        siblings = np.bincount(self.parent, ~self.root, n)[self.parent]
        mean = np.bincount(self.parent, np.where(self.root, 0, text), n)[self.parent] / np.maximum(siblings, 1)
        by = self.parent * (len(_KINDS) + 1) + self.kind + 1
        _, code, count = np.unique(by, return_inverse=True, return_counts=True)
        order = np.argsort(self.parent, kind="stable")  # siblings in page order
        head = np.concatenate([[True], self.parent[order][1:] != self.parent[order][:-1]])
        rank = np.empty(n)
        rank[order] = np.arange(n) - np.maximum.accumulate(np.where(head, np.arange(n), 0))
        some = np.maximum(text, 1)
        numbers = [self.depth, np.log1p(self.own), np.log1p(text), links / some, np.log1p(tags), np.log1p(text / tags),
                   text / np.maximum(whole, 1), started / np.maximum(whole, 1), np.log1p(siblings), np.log1p(count[code]),
                   rank / np.maximum(siblings, 1), np.log1p(mean), text / np.maximum(mean, 1), self.subtree(self.commas) / some,
                   self.own / some]
        return np.hstack([kinds, bits, above, np.stack(numbers, axis=1)]).astype(np.float32)

    def furniture(self) -> np.ndarray:
        """Elements that say they are page furniture, or lie in such."""
        bad = np.isin(self.kind, _INHERITED[:5]) | ((self.flags & ~(1 << _CONTENT)) != 0)
        return self.down(bad)

    def rule(self) -> np.ndarray:
        """Which elements the page's own markup says are content, with the
        containers of content; frames (html, body) are left out."""
        bad = self.furniture()
        inside = self.down((self.kind == _KIND["article"]) & ~bad) & ~bad & ~self.unseen
        return inside | ((self.subtree(inside) > 0) & ~bad)

    def decode(self, logit: np.ndarray) -> np.ndarray:
        """Kept elements: the best choice in which a kept element's ancestors
        are kept.  Frames always are."""
        logit = np.where(self.frame, 0.0, logit)
        plain, running = ((self.flags == 0) & np.isin(self.kind, k) for k in (_PLAIN, _RUNNING))
        for at in self.levels:
            own = at[plain[at]]
            logit[own] = (logit[own] + logit[self.parent[own]]) / 2
            own = at[running[at]]
            logit[own] = logit[self.parent[own]]
        logit = np.where(self.unseen, -1e6, logit)
        kept = self._best(logit)
        if self.loose.any():
            kept = self._best(self._straight(logit, kept))
        shown = np.bincount(self.page, np.where(kept & ~self.frame, self.own, 0), len(self.pages))
        if (shown == 0).any():
            rule, rest = self.rule(), ~self.furniture() & ~self.unseen
            named = np.bincount(self.page, rule & ~self.frame, len(self.pages)) > 0
            marked = np.where(named[self.page], rule, rest) | (self.frame & ~self.unseen)
            kept = np.where((shown == 0)[self.page], marked, kept)
        return kept

    def _best(self, logit: np.ndarray) -> np.ndarray:
        drop = -self.subtree(logit)
        keep = logit.copy()
        for at in self.levels[::-1]:
            np.add.at(keep, self.parent[at], np.maximum(keep[at], drop[at]))
        kept = self.frame | (keep > drop)
        for at in self.levels:
            kept[at] &= kept[self.parent[at]]
        return kept & ~self.unseen

    def _straight(self, logit: np.ndarray, kept: np.ndarray) -> np.ndarray:
        """The log-odds, with those of loose text, and of the plain elements
        beside it, by how much of the page's text lies straight in body."""
        text = self.subtree(self.own)
        links = self.subtree(np.where(self.down(self.kind == _KIND["a"]), self.own, 0))
        pages = len(self.pages)
        has = np.bincount(self.page, self.loose, pages) > 0
        plain = (self.flags == 0) & np.isin(self.kind, _PLAIN) & self.frame[self.parent] & ~self.unseen & has[self.page]
        mostly = plain & (2 * links < text)
        beside = self.down(plain)
        straight = np.bincount(self.page, np.where(mostly, text, 0), pages)
        boxed = np.bincount(self.page, np.where(kept & ~self.frame & ~beside, self.own, 0), pages)
        named = np.bincount(self.page, self.rule() & ~self.frame, pages) > 0
        content = ((straight >= boxed) & ~named)[self.page]
        own = np.where(self.loose, np.where(mostly & content, 1.0, -1.0), np.where(mostly & content, np.maximum(logit, 1.0), logit))
        out = np.where(plain, own, logit)
        running = (self.flags == 0) & np.isin(self.kind, _RUNNING) & beside
        parts = (self.flags == 0) & np.isin(self.kind, _PLAIN) & ~plain & self.down(mostly & content)  # items and cells
        for at in self.levels:
            inner = at[(running | parts)[at]]
            out[inner] = out[self.parent[inner]]
        return np.where(self.unseen, -1e6, out)

    def texts(self, kept: np.ndarray) -> list[str]:
        out = []
        kept = kept.tolist()
        for i, p in enumerate(self.pages):
            f = int(self.first[i])
            blocks: dict[int, list[str]] = {}
            for e, text, block in p.runs:
                if kept[f + e] and p.tag[e] not in dom.FRAME:
                    blocks.setdefault(block, []).append(text)
            lines = (" ".join("".join(b).split()) for b in blocks.values())
            out.append("\n".join(x for x in lines if x))
        return out


# ------------------------------------------------------------------ fitting

def _render(rng: random.Random, content: list[tuple[str, str]], other: list[str], foreign: list[str]) -> str:
    """The page's texts in a template drawn at random.  Elements carry their
    label as the attribute y."""
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;")
    pick = lambda: " ".join((rng.choice(other) if other else "x").split()[:rng.randint(2, 14)])
    long = lambda: rng.choice(foreign) if foreign else pick()

    def name(*words):
        """Class, id, or nothing."""
        w = rng.choice(words)
        w = rng.choice([w, f"{w}-{rng.choice(['box', 'wrap', 'area', 'inner', 'top'])}", f"site-{w}", f"{w} clearfix"])
        return rng.choice([f' class="{w}"', f' id="{w}"', f' class="{w}"'])

    def el(tag, attrs, inner, y):
        return f"<{tag}{attrs} y={y}>{inner}</{tag}>"

    def links(n):
        return el("ul", "", "".join(el("li", "", el("a", f' href="/{i}"', esc(" ".join(pick().split()[:2])), 0), 0) for i in range(n)), 0)

    def paras(n):
        return "".join(el("p", "", esc(long() if rng.random() < 0.5 else pick()), 0) for _ in range(n))

    menu = lambda: rng.choice([el("nav", "", links(rng.randint(2, 9)), 0), el("div", name("menu", "nav", "navbar", "breadcrumb"), links(rng.randint(2, 9)), 0)])
    head = lambda: el(*rng.choice([("header", ""), ("div", name("header", "masthead", "banner", "topbar"))]), el(rng.choice(["div", "p", "h1", "span"]), "", esc(pick()), 0) + (menu() if rng.random() < 0.5 else ""), 0)
    foot = lambda: el(*rng.choice([("footer", ""), ("div", name("footer", "copyright", "legal"))]), rng.choice(["&copy; ", ""]) + esc(pick()) + (paras(1) if rng.random() < 0.4 else ""), 0)
    side = lambda: el(*rng.choice([("aside", ""), ("aside", name("sidebar")), ("div", name("sidebar", "related", "widget"))]), rng.choice([links(5), paras(2), el("h3", "", esc(pick()), 0) + links(3)]), 0)
    note = lambda: el(rng.choice(["div", "p", "section"]), name("cookie", "notice", "consent", "newsletter", "alert"), rng.choice([esc(pick()), paras(1)]), 0)
    advert = lambda: el(rng.choice(["div", "p", "section", "aside"]), name("ad", "ads", "advert", "sponsored", "promo"), rng.choice([esc(pick()), paras(1)]), 0)
    form = lambda: el("form", rng.choice(["", name("login", "search", "subscribe")]), el(rng.choice(["p", "div", "span"]), "", esc(pick()), 0) + "<input y=0>" + el("button", "", "ok", 0), 0)
    comments = lambda: el(rng.choice(["div", "section", "ol"]), name("comments", "comment", "replies", "discussion"), "".join(el(rng.choice(["div", "li", "p"]), rng.choice(["", name("comment")]), paras(rng.randint(1, 2)), 0) for _ in range(rng.randint(1, 4))), 0)
    share = lambda: el("div", name("share", "social"), links(3), 0)
    between = [advert, note, side, share, form]

    body = []
    for tag, text in content:
        body.append(el(tag if tag in ("h1", "h2", "h3", "li", "pre", "blockquote") else rng.choice(["p", "p", "p", "div"]), "", esc(text), 1))
        if rng.random() < 0.12:
            body.append(rng.choice(between)())
    if rng.random() < 0.3:
        body.append(rng.choice([comments, share, foot])())
    wrap = rng.choice([("article", ""), ("main", ""), ("div", name("content", "post", "entry", "article", "story")), ("section", name("post", "content")), ("div", ""), ("article", name("post"))])
    main = el(*wrap, "".join(body), 1) if content else ""
    if rng.random() < 0.3:
        main = el("div", rng.choice(["", name("main", "page")]), rng.choice([side() + main, main + side(), main]), 1)
    before = "".join(rng.choice([head, menu, note, advert, form])() for _ in range(rng.randint(1, 3)))
    after = "".join(rng.choice([foot, comments, side, advert, note, share])() for _ in range(rng.randint(1, 3)))
    return f"<html y=0><head y=0><title y=0>{esc(pick())}</title></head><body y=0><script y=0>var a='<p>';</script>{before}{main}{after}</body></html>"


_Y = re.compile(r"(?:^|\s)y=([01])(?=\s|/|$)")


def _examples(batches):
    """(page_id, html) to rows (features, label) of elements, of the pages
    themselves and of their variants."""
    for batch in batches:
        ids, htmls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        pages = Pages(htmls)
        rule = pages.rule()
        use = ~pages.frame & ~pages.unseen
        x, y = [pages.features()[use]] * 2, [rule[use]] * 2  # as much weight as two variants
        parts = []
        for i, p in enumerate(pages.pages):
            f = int(pages.first[i])
            content, other, last = [], [], None
            for e, text, block in p.runs:
                text = " ".join(text.split())
                if not text or pages.unseen[f + e]:
                    continue
                if not rule[f + e] or p.tag[e] in ("html", "body", "#page"):
                    other.append(text)
                elif block == last:
                    content[-1] = (content[-1][0], f"{content[-1][1]} {text}")
                else:
                    content.append((p.tag[e], text))
                    last = block
            parts.append((content, other))
        rng = random.Random(7)
        variants = []
        for content, other in parts:
            foreign = [t for _, t in parts[rng.randrange(len(parts))][0]][:8]
            variants += [_render(rng, content, other, foreign) for _ in range(VARIANTS if content else 0)]
        if variants:
            made = Pages(variants)
            label = np.array([(m[1] == "1") if (m := _Y.search(a)) else False for a in made.raw])
            use = ~made.frame & ~made.unseen
            x.append(made.features()[use])
            y.append(label[use])
        x, y = np.concatenate(x), np.concatenate(y)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.astype(np.uint8).tobytes()], pa.binary())],
                                         names=["x", "y"])


def fit(pages: DataFrame, sample: int = SAMPLE, id_col: str = "page_id", html_col: str = "html") -> boosting.Trees | None:
    """Trees fitted on at most ``sample`` pages; None without content."""
    common.bound_batches(pages.sparkSession)
    ids = pages.select(F.col(id_col).cast("long").alias("i")).dropna().distinct().orderBy(F.xxhash64("i"), "i").limit(sample)
    chosen = [r.i for r in ids.collect()]  # at most ``sample`` numbers
    rows = pages.filter(F.col(id_col).cast("long").isin(chosen)).select(F.col(id_col).cast("long").alias("i"), F.col(html_col).cast("string").alias("h"))
    rows = common.stage(rows.dropDuplicates(["i"]).repartition(4, "i").sortWithinPartitions("i"), "page-sample")
    got = sorted(rows.mapInArrow(_examples, "x binary, y binary").collect())
    if not got:
        return None
    y = np.concatenate([np.frombuffer(r.y, np.uint8) for r in got]).astype(float)
    x = np.concatenate([np.frombuffer(r.x, np.float32) for r in got]).reshape(len(y), -1) if len(y) else np.zeros((0, 1))
    if not len(y) or y.min() == y.max():
        return None
    return boosting.fit(x, y)


def _extract(trees, batches):
    for batch in batches:
        for i, j in arrays.slices(batch.column(2)):
            for a in range(i, j, PAGES):
                part = batch.slice(a, min(PAGES, j - a))
                p = Pages(part.column(2).to_pylist())
                logit = trees.value.logit(p.features()) if trees.value is not None else np.where(
                    p.rule() | ~p.rule().any(), 1.0, -1.0)
                texts = p.texts(p.decode(logit))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    spark = pages.sparkSession
    trees = spark.sparkContext.broadcast(fit(pages, sample))
    d = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return d.mapInArrow(partial(_extract, trees), "page_id long, url string, text string, n_chars long")
