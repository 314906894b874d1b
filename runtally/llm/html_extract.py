"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read into its leaf blocks: runs of text between the edges of block elements, in
page order. Every block carries the features of all its ancestors (tags, roles, parts of
class and id) and of its text (length, share of links, marks, own tag). The field has two
labels, main text or not; its weights are fitted by maximum likelihood (forward-backward),
pages are decoded by Viterbi, and the blocks labelled main are joined in page order.

Labelled pages. The table has no labels, so they are made from at most ``FIT_PAGES`` pages (a
documented bound: those with the smallest hash of page_id; of them those of up to ``FIT_CHARS``
characters, ``FIT_BLOCKS`` blocks and ``FIT_ELEMENTS`` elements are used):

- a page with an ``article`` or ``main`` element is labelled by it: its blocks inside are main
  text but for those in an element of ``CHROME_TAGS`` inside it;
- the texts of every such page are set again in ``VARIANTS`` made-up layouts, whose labels are
  known by construction. Layouts name their parts as pages commonly do (``CONTENT`` and
  ``CHROME``, fixed lists), nest adverts, comments, forms and menus in the article, put long
  paragraphs into comments, and may do without any telling name, so neither an ``article`` tag
  nor one word decides alone.

Reading takes a page in one pass whose time is linear in its length, however deep or broken:
an element's score is its parent's plus that of the features that are new below it.

Defined cases: a null html is an empty one; a page without main text has an empty text and 0
characters; white space is space and \\t to \\r, so a decoded no-break space stays; a ``br`` is
white space; an unfinished tag or comment at the end of a page is dropped, text before it
stays; without any text to learn from every block counts as main text; null and repeated
page_ids are kept row by row; of a repeated page_id the smallest html is fitted; an empty
table gives an empty result; only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtally.llm.common import SPACES, materialise, ship

FIT_PAGES = 240
FIT_CHARS = 200_000
FIT_BLOCKS = 200
FIT_ELEMENTS = 2000
VARIANTS = 5
MIN_SEEN = 3  # blocks of the labelled pages that must show a feature
RIDGE = 1e-3
STEPS = 250

# How elements behave in HTML.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre
search section select summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style template noscript iframe noframes noembed xmp textarea title svg".split())
CLOSES_P = BLOCKS - frozenset("body button caption html label legend optgroup option tbody td tfoot th thead tr select".split())
# A start tag ends an open element of these, up to the nearest element of the second list.
ENDS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "option": (("option",), ("select",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}
SCOPES = frozenset("html table td th caption button object".split())

# What pages call their parts.
CONTENT = ("content article post entry story text prose markdown body post-content entry-content article-body article-content main-content "
           "page-content story-body post-body rich-text").split()
NEUTRAL = "wrapper container page site row col layout inner wrap grid main outer root app column".split()
CHROME: dict[str, tuple[str, str]] = {  # kind: (tags, names)
    "menu": ("nav ul div", "menu nav navbar navigation breadcrumb breadcrumbs topnav tabs toc main-menu nav-links site-nav pagination pager"),
    "header": ("header div", "header masthead site-header top logo branding page-header topbar tagline"),
    "footer": ("footer div", "footer site-footer copyright bottom legal colophon page-footer credits"),
    "sidebar": ("aside div section", "sidebar side widget related recommended trending popular rail read-more sidebar-right related-posts most-read"),
    "notice": ("div section p", "cookie cookies consent notice alert banner gdpr popup modal message warning cookie-banner cookie-notice newsletter "
                                "subscribe paywall overlay toast announcement"),
    "advert": ("div aside ins section", "ad ads advert advertisement sponsor sponsored promo promotion ad-slot ad-container adsbox banner-ad advertorial"),
    "form": ("form div", "search login form contact signup subscribe-form search-form register comment-form"),
    "comments": ("section div ol", "comments comment comment-list commentlist respond replies discussion reader-comments responses"),
    "share": ("div ul", "share social sharing share-buttons social-links follow"),
}
CHROME_TAGS = frozenset("nav aside footer form".split())

_MARK = re.compile(r"<(?:!--|[!?]|/?[A-Za-z]|/)")
_NAME = re.compile(r"[^\s/>]+")
_ATTR = re.compile(r"""[\s/]*(?:([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))?)?)?""")
_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in UNREAD}
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(f"[{SPACES}]+")
_NAMED = ("class", "id", "role", "itemprop")


def _tags(page: str) -> Iterator[tuple[int, int, str, str, dict]]:
    """(start, end, kind, name, attributes) of every mark-up piece; kind: open, close or other."""
    at, size = 0, len(page)
    while (m := _MARK.search(page, at)) is not None:
        i = m.start()
        mark = m.group()
        if mark == "<!--":
            end = page.find("-->", i + 2)
            at = size if end < 0 else end + 3
            yield i, at, "other", "", {}
        elif mark in ("<!", "<?", "</"):
            end = page.find(">", i)
            at = size if end < 0 else end + 1
            yield i, at, "other", "", {}
        else:
            closing = mark[1] == "/"
            n = _NAME.match(page, i + 1 + closing)
            name, j, attrs = n.group().lower(), n.end(), {}
            while True:
                a = _ATTR.match(page, j)
                j = a.end()
                if a.group(1) is None:
                    break
                if a.group(1).lower() in _NAMED and not closing:
                    attrs.setdefault(a.group(1).lower(), a.group(2) or a.group(3) or a.group(4) or "")
            if j >= size:  # the page ends inside a tag
                yield i, size, "other", "", {}
                return
            at = j + 1  # page[j] is '>'
            yield i, at, "close" if closing else "open", name, attrs
            if not closing and name in UNREAD:
                e = _END[name].search(page, at)
                if e is None:
                    yield at, size, "other", "", {}
                    return
                yield at, e.start(), "other", "", {}
                at = e.start()


def _named(tag: str, attrs: dict) -> list[str]:
    """Features that an element hands down to the blocks below it."""
    out = [f"t:{tag}"]
    for key in _NAMED:
        for part in _PARTS.findall(attrs.get(key, "")):
            part = part.lower()
            out.append(f"c:{part}")
            if len(part) > 4:
                out.append(f"k:{part[:4]}")
    return out


def _of_text(text: str, tag: str, linked: int) -> list[str]:
    """Features of a block's text and of the element it stands in."""
    words = text.count(" ") + 1
    size = next(str(n) for n in (1, 3, 6, 12, 25, 50, 1 << 62) if words <= n)
    links = linked / len(text)
    link = "0" if links == 0 else "s" if links < 0.5 else "l"
    out = [f"n:{size}", f"l:{link}", f"o:{tag}", f"on:{tag}{size}", f"e:{text[-1] if not text[-1].isalnum() else 'w'}"]
    if "©" in text:
        out.append("copyright")
    if text.count(",") * 12 > words:
        out.append("commas")
    return out


@dataclass
class Page:
    texts: list[str]
    own: list[list[str]]  # text features of each block
    frame: list[int]  # the element each block stands in
    parent: list[int]  # of each element
    new: list[list[str]]  # its features that no ancestor has
    tag: list[str]

    def features(self, k: int) -> list[str]:
        out, f = list(self.own[k]), self.frame[k]
        while f >= 0:
            out += self.new[f]
            f = self.parent[f]
        return out

    def inside(self, k: int) -> Iterator[str]:
        f = self.frame[k]
        while f >= 0:
            yield self.tag[f]
            f = self.parent[f]


def read(page: str | None) -> Page:
    """Leaf blocks of a page in page order."""
    page = page or ""
    out = Page([], [], [], [], [], [])
    stack: list[int] = []  # open elements
    at_depth: dict[str, list[int]] = {}  # tag -> depths of its open elements
    scopes: list[int] = []  # depths of open scopes
    shown: dict[str, int] = {}  # feature -> open elements that have it as new
    pieces: list[str] = []
    links, linked = 0, 0
    blocks: list[int] = [-1]  # open block elements

    def flush():
        nonlocal linked
        text = _SPACE.sub(" ", "".join(pieces)).strip(" ")
        if text:
            f = blocks[-1]
            out.texts.append(text)
            out.own.append(_of_text(text, out.tag[f] if f >= 0 else "", min(linked, len(text))))
            out.frame.append(f)
        pieces.clear()
        linked = 0

    def pop(depth: int):
        nonlocal links
        while len(stack) > depth:
            f = stack.pop()
            tag = out.tag[f]
            at_depth[tag].pop()
            if tag in SCOPES:
                scopes.pop()
            if tag in BLOCKS:
                flush()
                blocks.pop()
            links -= tag == "a"
            for x in out.new[f]:
                del shown[x]

    def depth_of(tag: str, stops: tuple = ()) -> int | None:
        depths = at_depth.get(tag)
        if not depths:
            return None
        stop = max([scopes[-1] if scopes else -1, *(at_depth[s][-1] for s in stops if at_depth.get(s))])
        return depths[-1] if depths[-1] > stop or tag in SCOPES else None

    def add(raw: str):
        nonlocal linked
        text = entities.unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if links:
            linked += len(text)

    done = 0
    for start, end, kind, tag, attrs in _tags(page):
        if start > done:
            add(page[done:start])
        done = end
        if kind == "open":
            if tag == "br":
                pieces.append(" ")
                continue
            if tag in CLOSES_P and (d := depth_of("p")) is not None:
                pop(d)
            for ended in ENDS.get(tag, ((), ()))[0]:
                if (d := depth_of(ended, ENDS[tag][1])) is not None:
                    pop(d)
            if tag in BLOCKS:
                flush()
            if tag in VOID:
                continue
            f = len(out.tag)
            out.tag.append(tag)
            out.parent.append(stack[-1] if stack else -1)
            fresh = [x for x in dict.fromkeys(_named(tag, attrs)) if x not in shown]
            out.new.append(fresh)
            for x in fresh:
                shown[x] = 1
            at_depth.setdefault(tag, []).append(len(stack))
            if tag in SCOPES:
                scopes.append(len(stack))
            stack.append(f)
            if tag in BLOCKS:
                blocks.append(f)
            links += tag == "a"
        elif kind == "close" and tag not in VOID:
            if tag in ("body", "html"):  # what follows stays where it is
                continue
            if (d := depth_of(tag)) is not None:
                pop(d)
        elif kind == "close" and tag == "br":
            pieces.append(" ")
    if done < len(page):
        add(page[done:])
    flush()
    return out


# ---------------------------------------------------------------- labelled pages


def labels_of(page: Page) -> list[int] | None:
    """1 for the blocks inside an article or main element but not in chrome inside it; None without such an element."""
    labels = []
    for k in range(len(page.texts)):
        label = 0
        for tag in page.inside(k):
            if tag in CHROME_TAGS:
                break
            if tag in ("article", "main"):
                label = 1
                break
        labels.append(label)
    return labels if any(labels) else None


def _element(tag: str, names: list[str], body: str, rng: random.Random) -> str:
    attrs = ""
    if names:
        attrs = f' {rng.choice(("class", "class", "id"))}="{" ".join(names)}"'
    return f"<{tag}{attrs}>{body}</{tag}>"


def layout(main: list[str], other: list[str], rng: random.Random) -> tuple[str, list[int]]:
    """A made-up page around ``main`` texts, and the labels of its blocks."""
    labels: list[int] = []
    esc = entities.escape

    def words(most: int) -> str:
        w = rng.choice(other if other and rng.random() < 0.7 else main).split(" ")
        return esc(" ".join(w[:rng.randint(1, most)])) or "x"

    def long_text() -> str:
        return esc(rng.choice(main))

    def block(text: str, label: int, tag: str = "p") -> str:
        labels.append(label)
        return f"<{tag}>{text}</{tag}>"

    def link(text: str) -> str:
        return f'<a href="#">{text}</a>'

    def chrome(kind: str) -> str:
        tags, names = (v.split() for v in CHROME[kind])
        tag, name = rng.choice(tags), [rng.choice(names)] if rng.random() < 0.85 else []
        if tag in ("div", "section", "p", "ul", "ol") and not name:
            name = [rng.choice(names)]
        if kind == "menu":
            items = [block(link(words(2)), 0, "li") for _ in range(rng.randint(2, 7))]
            body = "".join(items) if tag == "ul" else f"<ul>{''.join(items)}</ul>"
        elif kind == "share":
            body = "".join(block(link(words(1)), 0, "li") for _ in range(rng.randint(2, 4)))
            body = body if tag == "ul" else f"<ul>{body}</ul>"
        elif kind == "form":
            inner = [block(words(3), 0, "label"), "<input name=q>", block(words(2), 0, "button")]
            if rng.random() < 0.4:
                inner.insert(0, block(words(6), 0))
            body = "".join(inner)
        elif kind == "comments":
            item = rng.choice(["li", "li", "div", "article"] if tag != "ol" else ["li"])
            body = block(words(3), 0, rng.choice(("h2", "h3"))) if tag != "ol" else ""
            for _ in range(rng.randint(1, 4)):
                who = block(words(2), 0, rng.choice(("p", "h4", "div"))) if rng.random() < 0.5 else ""
                said = block(long_text() if rng.random() < 0.7 else words(12), 0)
                body += _element(item, [rng.choice(("comment", "reply", "comment-body"))] if rng.random() < 0.6 else [], who + said, rng)
        elif tag == "p":
            labels.append(0)
            body = words(14)
        else:
            body = block(words(3), 0, rng.choice(("h2", "h3", "h4"))) if rng.random() < 0.4 else ""
            for _ in range(rng.randint(1, 3)):
                t = long_text() if rng.random() < 0.2 else words(16)
                r = rng.random()
                if r < 0.3 and kind != "notice":
                    body += block(link(t), 0, rng.choice(("li", "p", "div")))
                elif r < 0.6:
                    labels.append(0)
                    body += t if not body.endswith(t) else ""
                    break
                else:
                    body += block(t, 0)
        return _element(tag, name, body, rng)

    def content() -> str:
        tag = rng.choice("article article main div div section td".split())
        names = [rng.choice(CONTENT)] if rng.random() < 0.7 else []
        body = ""
        if rng.random() < 0.7:
            title = block(words(10), 1, "h1")
            body += f"<header>{title}</header>" if rng.random() < 0.2 else title
        inside = [rng.choice(list(CHROME)) for _ in range(rng.choice((0, 0, 0, 1, 2)))]
        cuts = sorted((rng.randint(0, len(main)), kind) for kind in inside)
        for k, text in enumerate([*main, None]):
            while cuts and cuts[0][0] == k:
                body += chrome(cuts.pop(0)[1])
            if text is None:
                break
            t = esc(text)
            r = rng.random()
            if r < 0.08:
                body += f"<ul>{block(t, 1, 'li')}</ul>"
            elif r < 0.14:
                body += f"<blockquote>{block(t, 1)}</blockquote>"
            elif r < 0.2:
                body += block(t, 1, rng.choice(("h2", "h3", "div", "pre")))
            elif r < 0.23:
                body += f"<table><tr>{block(t, 1, 'td')}</tr></table>"
            elif r < 0.3 and " " in t:
                head, tail = t.split(" ", 1)
                body += block(f"{link(head)} <b>{tail}</b>", 1)
            else:
                body += block(t, 1)
        made = _element(tag, names, body, rng)
        return f"<table><tr>{made}</tr></table>" if tag == "td" else made

    def some(kinds: str, chance: float) -> str:
        return "".join(chrome(k) for k in kinds.split() if rng.random() < chance)

    parts = [some("notice header menu advert form sidebar", 0.4), content(), some("share advert comments form sidebar notice", 0.35), some("menu footer", 0.5)]
    body = "".join(parts)
    for _ in range(rng.randint(0, 2)):
        body = _element("div", [rng.choice(NEUTRAL)] if rng.random() < 0.7 else [], body, rng)
    return f"<!DOCTYPE html><html><head><title>{words(5)}</title></head><body>{body}</body></html>", labels


def labelled(page_html: str) -> list[tuple[Page, list[int]]]:
    """The page itself if its mark-up labels it, and its texts in made-up layouts."""
    page = read(page_html)
    if not page.texts or len(page.texts) > FIT_BLOCKS or len(page.tag) > FIT_ELEMENTS:
        return []
    labels = labels_of(page)
    out = [(page, labels)] if labels else []
    main = [t for t, y in zip(page.texts, labels or []) if y] or [t for t in page.texts if t.count(" ") >= 8]
    other = [t for t, y in zip(page.texts, labels or []) if not y] or [t for t in page.texts if t.count(" ") < 8]
    if main:
        rng = random.Random(xxhash.xxh64_intdigest(page_html.encode("utf-8", "replace")))
        for _ in range(VARIANTS):
            n = rng.randint(1, min(len(main), 12))
            at = rng.randint(0, len(main) - n)
            made, known = layout(main[at:at + n], other, rng)
            again = read(made)
            if len(again.texts) == len(known):
                out.append((again, known))
    return out


# ---------------------------------------------------------------- the field


@dataclass
class Model:
    weights: dict[str, float]  # of a feature for label 1 against label 0
    start: np.ndarray  # label scores at the start of a page
    step: np.ndarray  # from label, to label


def fit(sequences: list[tuple[list[list[str]], list[int]]]) -> Model | None:
    """Maximum penalised likelihood; ``sequences``: features of each block, and labels, of each page."""
    if len({y for _, ys in sequences for y in ys}) < 2:
        return None
    sequences = sorted(sequences, key=lambda s: -len(s[1]))
    seen: dict[str, int] = {}
    for blocks, _ in sequences:
        for feats in blocks:
            for f in feats:
                seen[f] = seen.get(f, 0) + 1
    number = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n >= MIN_SEEN))}
    count, longest, nf = len(sequences), len(sequences[0][1]), len(number)
    # blocks lie in one matrix, page by page in rows; pages are sorted by length, so those that reach place t come first
    cell, col = [], []
    gold = np.zeros((count, longest), np.int64)
    lens = np.array([len(ys) for _, ys in sequences])
    for k, (blocks, ys) in enumerate(sequences):
        gold[k, :len(ys)] = ys
        for t, feats in enumerate(blocks):
            known = [number[f] for f in feats if f in number]
            cell += [k * longest + t] * len(known)
            col += known
    cell, col = np.array(cell, np.int64), np.array(col, np.int64)
    inside = np.arange(longest)[None, :] < lens[:, None]
    reach = [int((lens > t).sum()) for t in range(longest)]
    par = np.zeros(nf + 1 + 2 + 4)  # features, bias, start, steps
    m, v = np.zeros_like(par), np.zeros_like(par)
    total = lens.sum()
    g_step = np.zeros((2, 2))
    for k, n in enumerate(lens):
        np.add.at(g_step, (gold[k, :n - 1], gold[k, 1:n]), 1)
    g_start = np.bincount(gold[:, 0], minlength=2)
    for it in range(1, STEPS + 1):
        start, step = par[nf + 1:nf + 3], par[nf + 3:].reshape(2, 2)
        on = np.bincount(cell, par[col], count * longest).reshape(count, longest) + par[nf]
        score = np.stack([np.zeros_like(on), on], 2)
        fwd, bwd = np.zeros_like(score), np.zeros_like(score)
        fwd[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            n = reach[t]
            fwd[:n, t] = np.logaddexp.reduce(fwd[:n, t - 1, :, None] + step, axis=1) + score[:n, t]
        for t in range(longest - 2, -1, -1):
            n = reach[t + 1]
            bwd[:n, t] = np.logaddexp.reduce(step + (score[:n, t + 1] + bwd[:n, t + 1])[:, None, :], axis=2)
        z = np.logaddexp.reduce(fwd[:, 0] + bwd[:, 0], axis=1)
        p = np.exp(fwd + bwd - z[:, None, None]) * inside[:, :, None]
        grad = np.zeros_like(par)
        miss = (p[:, :, 1] - gold * inside).ravel()
        grad[:nf] = np.bincount(col, miss[cell], nf) / total + RIDGE * par[:nf] / nf ** 0.5
        grad[nf] = miss.sum() / total
        grad[nf + 1:nf + 3] = (p[:, 0].sum(axis=0) - g_start) / total
        e_step = np.zeros((2, 2))
        for t in range(1, longest):
            n = reach[t]
            pair = fwd[:n, t - 1, :, None] + step + (score[:n, t] + bwd[:n, t])[:, None, :] - z[:n, None, None]
            e_step += np.exp(pair).sum(axis=0)
        grad[nf + 3:] = ((e_step - g_step) / total).ravel()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        par -= 0.1 * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.99 ** it)) + 1e-8)
    weights = {f: float(par[k]) for f, k in number.items()}
    weights[""] = float(par[nf])
    return Model(weights, par[nf + 1:nf + 3].copy(), par[nf + 3:].reshape(2, 2).copy())


def decode(page: Page, model: Model) -> list[int]:
    """The likeliest labels (Viterbi)."""
    w = model.weights
    get = w.get
    handed: list[float] = []  # score that each element hands down
    for f, new in enumerate(page.new):
        up = page.parent[f]
        handed.append((handed[up] if up >= 0 else w[""]) + sum([get(x, 0.0) for x in new]))
    (s0, s1), ((a00, a01), (a10, a11)) = model.start.tolist(), model.step.tolist()
    back: list[tuple[int, int]] = []
    b0 = b1 = 0.0
    for k, own in enumerate(page.own):
        f = page.frame[k]
        on = (handed[f] if f >= 0 else w[""]) + sum([get(x, 0.0) for x in own])
        if k == 0:
            b0, b1 = s0, s1 + on
            back.append((0, 0))
        else:
            from0, from1 = (b0 + a00, b1 + a10), (b0 + a01, b1 + a11)
            back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
            b0, b1 = max(from0), max(from1) + on
    labels, y = [], int(b1 > b0)
    for k in range(len(back) - 1, -1, -1):
        labels.append(y)
        y = back[k][y]
    return labels[::-1]


def main_text(page_html: str | None, model: Model | None) -> str:
    page = read(page_html)
    if model is None:
        return "\n".join(page.texts)
    return "\n".join([t for t, y in zip(page.texts, decode(page, model)) if y])


# ---------------------------------------------------------------- jobs


def train(pages: DataFrame, limit: int = FIT_PAGES) -> Model | None:
    """The field, from at most ``limit`` pages; the driver gets their features only."""
    ship(pages.sparkSession)
    ids = pages.select(F.col("page_id").alias("chosen")).filter("chosen IS NOT NULL").distinct()
    ids = materialise(ids.orderBy(F.xxhash64("chosen"), "chosen").limit(limit))
    rows = pages.select("page_id", F.col("html").cast("string").alias("html")).filter(F.length("html") <= FIT_CHARS)
    rows = rows.join(F.broadcast(ids), F.col("page_id") == F.col("chosen"))  # at most ``limit`` ids
    rows = rows.groupBy("chosen").agg(F.min("html").alias("html")).select("html")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h in b.column("html").to_pylist():
                made = labelled(h)
                if made:
                    feats = ["\x1e".join("\x1f".join(p.features(k)) for k in range(len(p.texts))) for p, _ in made]
                    yield pa.RecordBatch.from_arrays([pa.array(feats), pa.array(["".join(map(str, ys)) for _, ys in made])], ["feats", "labels"])

    got = sorted(tuple(r) for r in rows.mapInArrow(task, "feats string, labels string").collect())
    return fit([([b.split("\x1f") for b in f.split("\x1e")], [int(c) for c in ys]) for f, ys in got])


def extract(pages: DataFrame, model: Model | None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars. Pages are read once and nothing is shuffled."""
    spark = pages.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py(), sent.value) for h in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return rows.mapInArrow(task, schema).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
