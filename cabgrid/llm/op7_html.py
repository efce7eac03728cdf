"""Main text of HTML pages by a linear-chain CRF over DOM leaf blocks (operator 7).

A page is cut into leaf blocks: runs of text not broken by a block element.
Each block has features of its ancestors (tags; words of class, id and role)
and of its text (length, links, punctuation, place in the page). A CRF with two
labels, main and other, scores the blocks and their neighbours; Viterbi gives
the best labelling, and the main blocks are joined.

Training pages are labelled two ways, both bounded: SAMPLE_PAGES pages of the
input by a keyed hash whose one <article> labels their blocks (less its parts
that are or name themselves menus, adverts, comments, share bars, forms or
notices), and GENERATED pages of known layout made by ``layouts``, whose text is
taken from those samples (from a word rule, if there are none). Only in training
a page is cut after SAMPLE_BLOCKS blocks, and paragraphs lent to generated pages
after PROSE_CHARS code points. Every page is then decoded, whole.

Edge cases: null or empty html, and pages without text, give an empty text;
cut-off tags, unclosed elements and comments, and stray end tags are read as
far as they go; pages of any length are read whole; ``page_id`` and ``url``
may be null; repeated rows are extracted like any other; other columns of any
name are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html import unescape
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import few_by_hash, table
from .textscan import slices

SAMPLE_PAGES = 120
SAMPLE_BYTES = 100_000
GENERATED = 720
SAMPLE_BLOCKS = 200
PROSE_CHARS = 2000
DIMENSIONS = 1 << 13
EPOCHS = 80
RATE = 0.1
PENALTY = 2e-4
MAIN, OTHER = 1, 0

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html head body p div section article main header footer nav aside ul ol li dl dt dd table caption thead tbody "
    "tfoot tr td th h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption form fieldset legend address hr details "
    "summary dialog center menu button option label hgroup search".split())
ENDS_P = BLOCK - {"button", "option", "label"}
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    # self-closed: an empty foreign element
    r"|<svg(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    r"|<(script|style|title|textarea|noscript|noframes|svg|iframe|template|select|object|video|audio|canvas)(?=[\s/>])[^>]*>"
    r"(?:.*?</\1(?=[\s/>])[^>]*>|.*\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+>"
    r"|<[!?/a-zA-Z][^>]*+\Z", re.S | re.I)
NAMED = re.compile(r"\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none", re.I)
SPLIT = re.compile(r"[^a-z]+")
REGIONS = frozenset("article main nav aside header footer form".split())


class Block:
    __slots__ = ("text", "path", "marks", "linked")

    def __init__(self, text: str, path: tuple[str, ...], marks: tuple[str, ...], linked: int):
        self.text, self.path, self.marks, self.linked = text, path, marks, linked


def _marks(tag: str, attributes: str) -> tuple[str, ...]:
    """Feature names of an element: its tag and the words naming it."""
    out = ["t:" + tag]
    if attributes and "=" in attributes or " hidden" in attributes:
        for a, b, c in NAMED.findall(attributes):
            for w in SPLIT.split(re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c).lower()):
                if w:
                    out.append("w:" + w)
                    if len(w) > 4:
                        out.append("w4:" + w[:4])
        if HIDDEN.search(attributes):
            out.append("hidden")
    return tuple(out)


def blocks(html: str) -> list[Block]:
    """The leaf blocks with text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                names = tuple(t for t, _ in stack)
                out.append(Block(text, names, tuple(m for _, ms in stack for m in ms), linked))
            pieces.clear()
        linked = 0

    def close(at: int) -> None:
        nonlocal links
        links -= sum(t == "a" for t, _ in stack[at:])
        del stack[at:]

    last = 0
    for m in TOKEN.finditer(html):
        a, b = m.span()
        if a > last:
            text = html[last:a]
            pieces.append(text)
            if links:
                linked += len(text)
        last = b
        tag = m[3] or m[6]
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if m[2] or m[5]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
        elif tag not in VOID:
            if tag in ENDS_P or tag == "li":
                for i in range(len(stack) - 1, -1, -1):
                    name = stack[i][0]
                    if name == "p" and tag in ENDS_P or name == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                        close(i)
                        break
                    if name in BLOCK:
                        break
            stack.append((tag, _marks(tag, m[4] or m[7] or "")))
            links += tag == "a"
    if last < len(html):
        pieces.append(html[last:])
        if links:
            linked += len(html) - last
    flush()
    return out


_SLOT: dict[str, int] = {}


def slot(name: str) -> int:
    s = _SLOT.get(name)
    if s is None:
        if len(_SLOT) > 200_000:
            _SLOT.clear()
        s = _SLOT[name] = zlib.crc32(name.encode()) % DIMENSIONS
    return s


def features(page: list[Block]) -> list[list[int]]:
    """The feature slots of each block."""
    out = []
    last = len(page) - 1
    told = [not {"article", "main"}.isdisjoint(b.path) for b in page]
    some = any(told)
    for i, b in enumerate(page):
        text = b.text
        words = text.count(" ") + 1
        share = b.linked / max(1, len(text))
        size = min(8, words.bit_length())
        own = next((t for t in reversed(b.path) if t in BLOCK), "none")
        names = {"bias", f"own:{own}", f"size:{size}", f"link:{min(4, int(share * 4.01))}", f"own:{own}:{min(size, 5)}"}
        names.update(b.marks)
        region = next((t for t in reversed(b.path) if t in REGIONS), "none")
        names.add(f"region:{region}:{own}")
        if some and not told[i]:
            names.add("outside")
        names.add(f"region:{region}:link:{min(2, int(share * 2.01))}:{min(size, 4)}")
        # What an element inside the text calls itself weighs apart from what the text's containers do.
        inside = max((j for j, m in enumerate(b.marks) if m in ("t:article", "t:main")), default=None)
        if inside is not None:
            own_at = next((j for j in range(inside + 1, len(b.marks)) if b.marks[j].startswith("t:")), len(b.marks))
            names.update("in:" + m for m in b.marks[own_at:])
        end = text[-1]
        names.add("end:" + ("stop" if end in ".!?…。»”\"" else "other"))
        names.add(f"commas:{min(3, text.count(','))}")
        if "©" in text:
            names.add("copyright")
        if words > 3 and share < 0.3:
            names.add("prose")
        if i == 0:
            names.add("first")
        if i == last:
            names.add("last")
        names.add(f"place:{4 * i // (last + 1)}")
        out.append([slot(n) for n in names])
    return out


class Tagger:
    """Two-label linear-chain CRF; weights (DIMENSIONS, 2), steps (2, 2), start (2)."""

    def __init__(self):
        self.weights = np.zeros((DIMENSIONS, 2), np.float32)
        self.steps = np.zeros((2, 2), np.float32)
        self.start = np.zeros(2, np.float32)

    def _scores(self, page: list[list[int]]) -> np.ndarray:
        flat = np.fromiter((s for f in page for s in f), np.int64)
        cuts = np.cumsum([0] + [len(f) for f in page[:-1]])
        return np.add.reduceat(self.weights[flat], cuts, axis=0)

    def labels(self, page: list[list[int]]) -> list[int]:
        """The best labelling (Viterbi)."""
        if not page:
            return []
        (oo, om), (mo, mm) = self.steps.tolist()
        scores = self._scores(page).tolist()
        o, m = scores[0][0] + float(self.start[0]), scores[0][1] + float(self.start[1])
        back = []
        for so, sm in scores[1:]:
            from_o, from_m = m + mo > o + oo, m + mm >= o + om
            back.append((from_o, from_m))
            o, m = so + (m + mo if from_o else o + oo), sm + (m + mm if from_m else o + om)
        at = int(m >= o)
        path = [at]
        for step in reversed(back):
            at = int(step[at])
            path.append(at)
        return path[::-1]

    def fit(self, pages: list[list[list[int]]], labels: list[list[int]]) -> "Tagger":
        """Maximum likelihood with an L2 penalty: all pages at once, padded to
        the longest; forward-backward in log space, Adam steps."""
        n, longest = len(pages), max(map(len, pages))
        flat = np.concatenate([np.array(f) for p in pages for f in p])
        of = np.concatenate([np.full(len(f), i * longest + j) for i, p in enumerate(pages) for j, f in enumerate(p)])
        there = np.zeros((n, longest), bool)
        gold = np.zeros((n, longest), np.int64)
        for i, y in enumerate(labels):
            there[i, :len(y)], gold[i, :len(y)] = True, y
        truth = np.eye(2)[gold] * there[..., None]
        pairs = (truth[:, :-1, :, None] * truth[:, 1:, None, :]).sum((0, 1))
        theta = np.zeros(2 * DIMENSIONS + 6)
        m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
        for epoch in range(1, EPOCHS + 1):
            w, steps, start = theta[:-6].reshape(-1, 2), theta[-6:-2].reshape(2, 2), theta[-2:]
            emit = np.stack([np.bincount(of, w[flat, k], n * longest) for k in (0, 1)], -1).reshape(n, longest, 2)
            forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
            forward[:, 0] = emit[:, 0] + start
            for t in range(1, longest):
                step = np.logaddexp.reduce(forward[:, t - 1, :, None] + steps, axis=1) + emit[:, t]
                forward[:, t] = np.where(there[:, t, None], step, forward[:, t - 1])
            for t in range(longest - 2, -1, -1):
                step = np.logaddexp.reduce(steps + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
                backward[:, t] = np.where(there[:, t + 1, None], step, 0)
            total = np.logaddexp.reduce(forward[:, -1], axis=1)
            chance = np.exp(forward + backward - total[:, None, None]) * there[..., None]
            joint = np.exp(forward[:, :-1, :, None] + steps + (emit + backward)[:, 1:, None, :] - total[:, None, None, None])
            joint = (joint * there[:, 1:, None, None]).sum((0, 1))
            wrong = (chance - truth).reshape(-1, 2)
            slope = np.concatenate([
                np.stack([np.bincount(flat, wrong[of, k], DIMENSIONS) for k in (0, 1)], -1).ravel(),
                (joint - pairs).ravel(), (chance[:, 0] - truth[:, 0]).sum(0)]) / n + PENALTY * theta
            m1 = 0.9 * m1 + 0.1 * slope
            m2 = 0.99 * m2 + 0.01 * slope ** 2
            theta -= RATE * (m1 / (1 - 0.9 ** epoch)) / (np.sqrt(m2 / (1 - 0.99 ** epoch)) + 1e-8)
        self.weights = theta[:-6].reshape(-1, 2).astype(np.float32)
        self.steps, self.start = theta[-6:-2].reshape(2, 2).astype(np.float32), theta[-2:].astype(np.float32)
        return self

    def extract(self, html: str | None) -> str:
        page = blocks(html or "")
        keep = self.labels(features(page))
        return "\n\n".join(b.text for b, y in zip(page, keep) if y == MAIN)


# Names that page authors give to the parts of a page.
MAIN_NAMES = ("content", "article", "main", "post", "entry", "story", "text", "body", "post-content", "entry-content",
              "article-body", "main-content", "story-text", "page-content", "single-post", "prose")
OTHER_NAMES = {
    "nav": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "main-menu", "topnav", "toc", "pagination", "tabs"),
    "header": ("header", "masthead", "site-header", "top", "topbar", "logo", "branding", "page-head", "site-title", "tagline"),
    "footer": ("footer", "site-footer", "bottom", "foot", "copyright", "legal", "colophon", "footer-links"),
    "aside": ("sidebar", "aside", "widget", "related", "rail", "popular", "trending", "recommended", "more", "side-column", "tags", "teaser", "author-box"),
    "notice": ("cookie", "notice", "banner", "consent", "alert", "gdpr", "cookie-banner", "message", "popup", "modal", "overlay", "privacy", "disclaimer"),
    "ad": ("ad", "ads", "advert", "sponsor", "sponsored", "promo", "advertisement", "ad-slot", "banner-ad", "promotion", "partner"),
    "form": ("form", "newsletter", "subscribe", "search", "login", "signup", "contact", "search-form"),
    "comments": ("comment", "comments", "discussion", "replies", "comment-list", "respond", "disqus", "reviews", "reader-comments", "user-comments"),
    "share": ("share", "social", "share-buttons", "follow", "sharing", "social-links"),
}


def _word(r: Random) -> str:
    return "".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(r.randint(1, 4)))


def layouts(prose: list[str], count: int, seed: int = 7) -> Iterator[tuple[list[Block], list[int]]]:
    """Labelled pages: paragraphs of ``prose`` as the main part, in containers
    and among other parts of many kinds, names and lengths."""
    r = Random(seed)
    prose = prose or [" ".join(_word(r) for _ in range(r.randint(5, 80))).capitalize() + "." for _ in range(400)]
    flag = "\x01"  # begins each main block's text, dropped after labelling

    def element(tag: str, names, inner: str, bare: float = 0.15) -> str:
        attribute = "" if r.random() < bare else f' {r.choice(("class", "class", "id"))}="{r.choice(names)}{r.choice(("", "", " col-8", " box", "-1"))}"'
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def some(low: int = 2, high: int = 9) -> str:
        words = r.choice(prose).split()
        return " ".join(words[:r.randint(low, high)]) or _word(r)

    def sentence() -> str:
        return r.choice(prose)[:r.randint(30, 400)]

    def other(kind: str, bare: float = 0.15) -> str:
        """A part that is no text; ``bare``: the chance that it has no name."""
        def named(tag: str, names, inner: str) -> str:
            return element(tag, names, inner, bare)

        names = OTHER_NAMES[kind]
        items = [some(1, 4) for _ in range(r.randint(2, 8))]
        listed = "".join(f'<li><a href="/{_word(r)}">{x}</a></li>' for x in items)
        if kind == "nav":
            return named(r.choice(("nav", "nav", "div", "ul")), names, r.choice((f"<ul>{listed}</ul>", listed, " ".join(f"<a href=#>{x}</a>" for x in items))))
        if kind == "header":
            return named(r.choice(("header", "div")), names, r.choice((f"<h1>{some()}</h1>", f"<a href=/>{some()}</a>", f"<p>{some()}</p>", f"<div>{some()}</div><p>{sentence()}</p>")))
        if kind == "footer":
            return named(r.choice(("footer", "footer", "div")), names, r.choice((f"&copy; {_word(r)}.com &middot; {sentence()}", f"<p>&copy; 20{r.randint(10, 30)} {some()}</p><ul>{listed}</ul>", f"<p>{sentence()}</p>", f"{sentence()}")))
        if kind == "aside":
            return named(r.choice(("aside", "aside", "div", "section")), names, r.choice((f"<h3>{some()}</h3><ul>{listed}</ul>", f"<h4>{some()}</h4><p>{sentence()}</p>", f"<p>{sentence()}</p><p>{sentence()}</p>", f"<ul><li>{some()}</li><li>{some()}</li></ul>")))
        if kind == "notice":
            return named(r.choice(("div", "div", "section", "p", "dialog")), names, r.choice((sentence(), f"<p>{sentence()}</p><button>{some(1, 2)}</button>", f"<p>{sentence()} <a href=#>{some(1, 2)}</a></p>")))
        if kind == "ad":
            return f"<!-- ad {r.randint(0, 99)} -->" + named(r.choice(("div", "div", "aside", "section")), names, r.choice((sentence(), f"<p>{sentence()}</p>", f"<a href=#>{some()}</a>", f"{sentence()}\n{sentence()}", f"<h4>{some()}</h4><p>{sentence()}</p>")))
        if kind == "form":
            return named(r.choice(("form", "form", "div")), names, f"<label>{some(1, 3)}</label><input name=q><p>{sentence()}</p><button>{some(1, 2)}</button>")
        if kind == "comments":
            each = "".join(named("div", ("comment", "reply", "comment-body"), r.choice((f"<b>{_word(r)}</b><p>{sentence()}</p>", f"<p>{sentence()}</p>", f"{_word(r)}: {sentence()}"))) for _ in range(r.randint(1, 5)))
            return named(r.choice(("section", "div", "ol")), names, r.choice(("", f"<h3>{some(1, 3)}</h3>")) + each)
        return named("div", names, "".join(f"<a href=#>{_word(r)}</a> " for _ in items[:4]))

    def article() -> str:
        parts = [f"<h1>{flag}{some(3, 12)}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.randint(1, 12)):
            kind, p = r.random(), r.choice(prose)
            if r.random() < 0.12:
                parts.append(other(r.choice(("ad", "ad", "share", "aside", "form", "notice", "nav", "comments")), 0.0))
            if kind < 0.70:
                parts.append(f"<p>{flag}{p}</p>")
            elif kind < 0.78:
                parts.append(f"<p><b>{flag}{p}<br>")
            elif kind < 0.86:
                parts.append(f"<h2>{flag}{some(2, 8)}</h2><p>{flag}{p}</p>")
            elif kind < 0.91:
                item = (lambda: f"{flag}{r.choice((some(1, 4), some(3, 20), r.choice(prose)))}")
                kinds = r.choice(("ul", "ul", "ol"))
                parts.append(f"<{kinds}>" + "".join(f"<li>{r.choice(('', '<p>'))}{item()}</li>" for _ in range(r.randint(1, 6))) + f"</{kinds}>")
            elif kind < 0.93:
                parts.append(f"<blockquote>{flag}{p}</blockquote>")
            elif kind < 0.96:
                parts.append(f"<p>{flag}{some(1, 4)} <a href=#>{some(1, 3)}</a> {p}</p>")
            else:
                parts.append(f"<table><tr><td>{flag}{some(1, 5)}</td><td>{flag}{some(1, 5)}</td></tr></table>")
        tag = r.choice(("article", "article", "main", "main", "div", "div", "section", "td"))
        inner = "".join(parts)
        if tag == "td":
            return f"<table><tr>{element('td', MAIN_NAMES, inner)}</tr></table>"
        wrapped = f"<{tag}>{inner}</{tag}>" if tag in ("article", "main") and r.random() < 0.5 else element(tag, MAIN_NAMES, inner)
        return element("div", (*MAIN_NAMES, "wrapper", "container", "page"), wrapped) if r.random() < 0.4 else wrapped

    for _ in range(count):
        before = [other(k) for k in ("header", "nav", "notice", "ad", "form", "share", "aside") if r.random() < (0.65 if k == "nav" else 0.35)]
        after = [other(k) for k in ("share", "aside", "ad", "form", "comments", "nav", "notice", "footer") if r.random() < (0.75 if k == "footer" else 0.5 if k == "comments" else 0.3)]
        if r.random() < 0.2:  # the text begins the page
            before = []
        text = article()
        if r.random() < 0.3:  # one container for the text and what stands beside it
            text = element("div", ("wrapper", "container", "page", "row", "layout"), text + other(r.choice(("aside", "ad", "comments", "share")), 0.0))
        body = "".join([*before, text, *after])
        if r.random() < 0.3:
            body = f"<div{r.choice((' id=page', ' class=container', ''))}>{body}</div>"
        if r.random() < 0.1:
            body = body[:r.randint(len(body) // 2, len(body))]
        page = blocks(f"<html><head><title>{some()}</title></head><body>{body}</body></html>")
        labels = [MAIN if b.text.startswith(flag) or flag in b.text else OTHER for b in page]
        for b in page:
            b.text = b.text.replace(flag, "") or "."
        if page:
            yield page, labels


#: Words by which a part of an article says that it is none of its text.
NOT_TEXT = frozenset(
    "ad ads advert advertisement sponsor sponsored promo comment comments disqus replies share sharing social newsletter "
    "subscribe signup login consent cookie sidebar related recommended widget menu nav navbar breadcrumb breadcrumbs toc".split())


def labelled(html: str) -> tuple[list[Block], list[int]] | None:
    """A page whose one <article> labels its blocks, else nothing. Parts of the
    article that are or name themselves something else are no text of it."""
    if len(re.findall(r"<article\b", html, re.I)) != 1:
        return None
    page = blocks(html)
    skip = {f"t:{t}" for t in ("nav", "aside", "footer", "form", "header")} | {f"w:{w}" for w in NOT_TEXT} | {"hidden"}
    labels = []
    for b in page:
        inner = b.marks[b.marks.index("t:article") + 1:] if "t:article" in b.marks else None
        own = next((i for i, m in enumerate(inner) if m.startswith("t:")), len(inner)) if inner is not None else 0
        labels.append(MAIN if inner is not None and not skip & set(inner[own:]) else OTHER)
    return (page, labels) if page else None


def train(samples: list[str]) -> Tagger:
    pages = [x for x in map(labelled, samples) if x]
    prose = [b.text[:PROSE_CHARS] for page, labels in pages for b, y in zip(page, labels) if y == MAIN and len(b.text) > 20]
    pages += layouts(prose, GENERATED)
    pages = [(p[:SAMPLE_BLOCKS], y[:SAMPLE_BLOCKS]) for p, y in pages]
    return Tagger().fit([features(p) for p, _ in pages], [y for _, y in pages])


def training_pages(pages: DataFrame, count: int = SAMPLE_PAGES) -> list[str]:
    """At most ``count`` pages of at most SAMPLE_BYTES bytes, by a keyed hash."""
    rows = (few_by_hash(pages, "page", "page_id", count).filter(F.col("html").isNotNull() & (F.octet_length("html") <= SAMPLE_BYTES))
            .select("html", F.xxhash64(F.lit("html"), "page_id").alias("h")).orderBy("h", "html").limit(count).collect())
    return [r["html"] for r in rows]


def extract(pages: DataFrame, tagger: Tagger) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(tagger)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = shared.value
        for batch in slices(batches, 2):
            texts = [use.extract(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long"), "url", "html")
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(training_pages(pages)))
