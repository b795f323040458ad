"""Main text of web pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi.

Each block is labelled main text or not from features of the elements around it and of its text; neighbouring labels
are tied by transition weights. The field is trained by gradient ascent on labelled pages, see ``labelled_pages``.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_blocks
from .dom import Block, blocks

#: Bound of the training sample: pages taken from the table.
SAMPLE_PAGES = 240

#: Layouts made from the words of each sampled page.
LAYOUTS = 3

#: Private mark that shows, while training, which text of a made layout is main text.
MAIN = "\ue000"

STOP = re.compile(r"[.!?…](?:\s|$)")


class Field(NamedTuple):
    """Weights of "main" against "other" per feature, and of the four transitions (from, to)."""

    weights: dict[str, float]
    moves: list[list[float]]


@lru_cache(maxsize=50_000)
def path_features(path: tuple[tuple[str, ...], ...]) -> tuple[str, ...]:
    """Features of the elements around a block."""
    found = {f"tag {e[0]}" for e in path} | {f"word {w}" for e in path for w in e[1:]}
    found |= {f"word {a} in {b[0]}" for b in path for a in b[1:]}
    near = [e[0] for e in path][-3:]
    found.add("near " + " ".join(near))
    found.add(f"in {near[-1] if near else 'none'}")
    found.add(f"depth {min(len(path), 10)}")
    return tuple(sorted(found))


def bucket(n: float) -> int:
    return min(int(n).bit_length(), 9)


def text_features(block: Block, place: int, total: int) -> list[str]:
    """Features of a block's text and of its place on the page."""
    text = block.text
    n, words = len(text), text.count(" ") + 1
    stops = len(STOP.findall(text))
    near = block.path[-1][0] if block.path else "none"
    out = [
        f"words {bucket(words)}", f"stops {bucket(stops)}", f"linked {4 * block.linked // n}", f"{near} words {bucket(words)}",
        f"place {5 * place // total}", f"ends {text[-1] in '.!?…:;,'}", f"stops by words {bucket(16 * stops // words)}",
    ]
    head = text[:1]
    out.append("starts " + ("upper" if head.isupper() else "lower" if head.islower() else "digit" if head.isdigit() else head))
    if "©" in text:
        out.append("copyright")
    if text.isupper():
        out.append("capitals")
    return out


def features(page: list[Block]) -> list[list[str]]:
    return [["bias", *path_features(b.path), *text_features(b, i, len(page))] for i, b in enumerate(page)]


def viterbi(scores: list[float], moves: list[list[float]]) -> list[int]:
    """Best labels for per-block scores of label 1 against label 0; ties go to label 0."""
    if not scores:
        return []
    a, b = 0.0, scores[0]
    back = []
    (m00, m01), (m10, m11) = moves
    for s in scores[1:]:
        a0, b0, a1, b1 = a + m00, b + m10, a + m01, b + m11
        back.append((b0 > a0, b1 > a1))
        a, b = max(a0, b0), max(a1, b1) + s
    label = int(b > a)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return out[::-1]


def fit(pages: list[list[list[str]]], labels: list[list[int]], *, rounds: int = 12, batch: int = 48, rate: float = 0.3, decay: float = 1e-4, seed: int = 42) -> Field:
    """Train by adaptive gradient steps on the log-likelihood of labelled pages (features per block, labels)."""
    index: dict[str, int] = {}
    pages_, labels_ = [], []
    for blocks_, ys in zip(pages, labels):
        if blocks_:
            pages_.append([np.array([index.setdefault(f, len(index)) for f in fs]) for fs in blocks_])
            labels_.append(np.array(ys))
    w, moves = np.zeros(len(index)), np.zeros((2, 2))
    seen_w, seen_m = np.full(len(index), 1e-6), np.full((2, 2), 1e-6)
    order = np.arange(len(pages_))
    rng = np.random.default_rng(seed)
    for _ in range(rounds if len(order) else 0):
        rng.shuffle(order)
        for i in range(0, len(order), batch):
            chosen = order[i : i + batch]
            flat = [f for p in chosen for f in pages_[p]]
            sizes = np.array([len(f) for f in flat])
            ids = np.concatenate(flat)
            score = np.add.reduceat(w[ids], np.append(0, np.cumsum(sizes)[:-1]))
            longest = max(len(labels_[p]) for p in chosen)
            lengths = np.array([len(labels_[p]) for p in chosen])
            at = np.arange(longest)[None] < lengths[:, None]
            s, y = np.zeros(at.shape), np.zeros(at.shape, int)
            s[at], y[at] = score, np.concatenate([labels_[p] for p in chosen])
            one, pair = expected(s, at, moves)
            grad = np.bincount(ids, np.repeat((y - one)[at], sizes), len(index)) / len(chosen) - decay * w
            both = at[:, 1:]
            grad_m = np.array([[np.sum(((y[:, :-1] == a) & (y[:, 1:] == b))[both]) - np.sum(pair[:, :, a, b][both]) for b in (0, 1)] for a in (0, 1)]) / len(chosen)
            seen_w += grad * grad
            seen_m += grad_m * grad_m
            w += rate * grad / np.sqrt(seen_w)
            moves += rate * grad_m / np.sqrt(seen_m)
    return Field({f: float(w[i]) for f, i in index.items()}, moves.tolist())


def expected(s: np.ndarray, at: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of label 1 per block, and of each pair of neighbouring labels, by forward and backward sums."""
    n, longest = s.shape
    emit = np.stack([np.zeros_like(s), s], 2)
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    forward[:, 0] = emit[:, 0]
    for t in range(1, longest):
        step = np.logaddexp(forward[:, t - 1, 0, None] + moves[0], forward[:, t - 1, 1, None] + moves[1]) + emit[:, t]
        forward[:, t] = np.where(at[:, t, None], step, forward[:, t - 1])
    for t in range(longest - 2, -1, -1):
        ahead = emit[:, t + 1] + backward[:, t + 1]
        step = np.logaddexp(moves[:, 0] + ahead[:, 0, None], moves[:, 1] + ahead[:, 1, None])
        backward[:, t] = np.where(at[:, t + 1, None], step, 0)
    whole = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    one = np.exp(forward[:, :, 1] + backward[:, :, 1] - whole[:, None]) * at
    pair = np.exp(np.minimum(
        forward[:, :-1, :, None] + moves + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - whole[:, None, None, None], 0))
    return one, pair


#: Words in class, id or role names that mark something other than the article.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie consent notice alert popup modal comment "
    "comments reply replies respond discussion disqus sidebar widget related recommended popular trending share social "
    "newsletter subscribe signup login search menu nav navbar navigation breadcrumb breadcrumbs pagination footer header "
    "masthead toolbar copyright legal complementary contentinfo".split()
)
ASIDE_TAGS = frozenset("nav footer aside form header menu button select dialog".split())


def landmark_labels(page: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article with ``article`` or ``main``; None if it does not.

    Blocks inside are main text unless an element within it, by tag or name, is something else.
    """
    labels, found = [], False
    for b in page:
        inside = [i for i, e in enumerate(b.path) if e[0] in ("article", "main") and not ASIDE_WORDS & set(e[1:])]
        found |= bool(inside)
        rest = b.path[inside[0] :] if inside else ()
        labels.append(int(bool(inside) and not any(e[0] in ASIDE_TAGS or ASIDE_WORDS & set(e[1:]) for e in rest)))
    return labels if found else None


def made_page(texts: list[str], rng: random.Random) -> str:
    """A page in one of many layouts, from the given texts; main text carries the private mark."""

    def prose(low: int, high: int) -> str:
        words = " ".join(rng.sample(texts, min(len(texts), 3))).split() or ["text"]
        n, i = rng.randint(low, high), rng.randrange(len(words))
        chosen = [words[(i + k) % len(words)] for k in range(n)]
        return " ".join(chosen).rstrip(".,") + "."

    short = lambda: prose(1, 3).rstrip(".")
    link = lambda: f'<a href="/{rng.randrange(999)}">{short()}</a>'

    def wrap(inside: str, *kinds: str) -> str:
        kind = rng.choice(kinds)
        tag, _, names = kind.partition(".")
        name = rng.choice(["class", "class", "id"])
        return f'<{tag} {name}="{names.replace(".", " ")}">{inside}</{tag}>' if names else f"<{tag}>{inside}</{tag}>"

    def links(n: int) -> str:
        if rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>"
        return " | ".join(link() for _ in range(n))

    def advert() -> str:
        return wrap(prose(2, 30), "div.ad", "div.advert", "div.ads.banner", "div.sponsored", "div.promo", "aside.advertisement", "div.adsbox", "section.sponsor")

    def notice() -> str:
        return wrap(f"<p>{prose(4, 30)}</p><button>{short()}</button>" if rng.random() < 0.5 else prose(4, 30),
                    "div.notice", "div.cookie-notice", "div.cookie-consent", "div.alert", "div.banner.notice", "section.consent", "div.popup.modal", "dialog", "aside.notice")

    def menu() -> str:
        return wrap(links(rng.randint(3, 9)), "nav", "nav", "div.menu", "div.navbar", "div.navigation", "div.nav", "div.breadcrumb", "div.topbar", "nav.main-menu")

    def header() -> str:
        inside = rng.choice(["", f"<h1>{short()}</h1>", f"<div>{short()}</div>"]) + rng.choice(["", f"<p>{prose(3, 14)}</p>"])
        return wrap((inside or prose(2, 12)) + rng.choice(["", menu(), form()]), "header", "header", "div.header", "div.site-header", "div.masthead", "div.page-header")

    def form() -> str:
        return rng.choice([
            f'<form><label>{short()}</label><input name="q"><button>{short()}</button></form>',
            f'<form class="newsletter"><p>{prose(4, 20)}</p><input><button>{short()}</button></form>',
            f'<form><p>{prose(3, 25)}</p><textarea>{prose(1, 9)}</textarea><select><option>{short()}</option><option>{short()}</option></select></form>',
            wrap(f"<p>{prose(4, 20)}</p><form><input><button>{short()}</button></form>", "div.subscribe", "div.signup", "div.search", "div.login"),
        ])

    def sidebar() -> str:
        inside = "".join(rng.choice([
            lambda: f"<h3>{short()}</h3>{links(rng.randint(2, 6))}", lambda: f"<p>{prose(5, 50)}</p>", lambda: f"<h3>{short()}</h3><p>{prose(5, 40)}</p>", advert,
        ])() for _ in range(rng.randint(1, 4)))
        return wrap(inside, "aside", "aside", "div.sidebar", "div.widget", "div.related", "section.popular", "div.recommended", "aside.sidebar", "div.side", "div.rail")

    def comments() -> str:
        one = lambda: rng.choice([
            lambda: wrap(f"<b>{short()}</b><p>{prose(3, 60)}</p>" + rng.choice(["", f"<a>{short()}</a>"]), "div.comment", "li.comment", "article.comment", "div.reply", "div.comment-body"),
            lambda: f"<li><span>{short()}</span><p>{prose(3, 60)}</p></li>", lambda: f"<p>{prose(3, 60)}</p>",
        ])()
        return wrap(f"<h3>{short()}</h3>" * rng.randint(0, 1) + "".join(one() for _ in range(rng.randint(1, 7))) + rng.choice(["", form()]),
                    "section.comments", "div.comments", "div.comment-list", "ol.commentlist", "div.discussion", "section.reader-comments", "div.responses", "div.user-comments")

    def footer() -> str:
        inside = rng.choice([f"&copy; {short()} &middot; {prose(2, 20)}", links(4), f"<p>{prose(3, 25)}</p>{links(3)}", f"<p>&copy; 2020 {prose(2, 14)}</p>"])
        return wrap(inside, "footer", "footer", "div.footer", "div.site-footer", "div.copyright", "div.legal")

    def body() -> str:
        mark = lambda t: MAIN + t
        part = lambda: rng.choice([
            lambda: f"<p>{mark(prose(3, 120))}</p>", lambda: f"<p>{mark(prose(15, 90))}</p>", lambda: f"<p>{mark(prose(1, 8))}", lambda: f"<p>{mark(prose(5, 30))} {link()} {prose(4, 30)}</p>",
            lambda: f"<p>{mark(prose(10, 60))}<br>{prose(10, 40)}</p>", lambda: f"<h2>{mark(short())}</h2>", lambda: f"<p><b>{mark(prose(2, 14))}<br>",
            lambda: "<ul>" + "".join(f"<li>{mark(prose(2, 20))}</li>" for _ in range(rng.randint(2, 5))) + "</ul>", lambda: f"<blockquote>{mark(prose(6, 40))}</blockquote>",
            lambda: f"<table><tr><td>{mark(short())}</td><td>{mark(short())}</td></tr></table>", lambda: f"<pre>{mark(prose(4, 30))}</pre>", lambda: f"<div>{mark(prose(12, 80))}</div>",
        ])()
        parts = [f"<p>{mark(prose(3, 120))}</p>" if rng.random() < 0.7 else part() for _ in range(rng.randint(1, 14))]
        if rng.random() < 0.8:
            parts.insert(0, f"<h1>{mark(prose(2, 14))}</h1>")
        for other in (advert, sidebar, notice, lambda: wrap(links(4), "div.share", "div.social", "div.tags"), form):
            if rng.random() < 0.12:
                parts.insert(rng.randint(1, len(parts)), other())
        if rng.random() < 0.15:
            parts.append(comments())
        return wrap("".join(parts), "article", "article", "main", "div.content", "div.post", "div.entry-content", "div.article-body", "div.main-content", "section.story", "div.text", "div.main")

    if rng.random() < 0.06:
        return rng.choice([f"<html><body>{MAIN}{prose(5, 90)}</body></html>", MAIN + prose(4, 60), "".join(f"<p>{MAIN}{prose(4, 80)}</p>" for _ in range(rng.randint(1, 6)))])
    before = [make() for make in (header, menu, notice, advert, sidebar, form) if rng.random() < 0.5]
    after = [make() for make in (sidebar, comments, advert, form, menu) if rng.random() < 0.5] + [footer() for _ in range(rng.random() < 0.85)]
    rng.shuffle(before)
    page = "".join([*before, body(), *after])
    if rng.random() < 0.3:
        page = f'<div class="{rng.choice(["wrapper", "container", "page", "site"])}">{page}</div>'
    return f"<html><head><title>{short()}</title></head><body>{page}</body></html>"


def labelled_pages(sample: list[str], layouts: int = LAYOUTS, seed: int = 42) -> tuple[list[list[Block]], list[list[int]]]:
    """Pages with labels: those of ``sample`` that mark their article, and made layouts filled with the words of the
    sample, in which menus, headers, footers, sidebars, notices, adverts, forms and comments are known."""
    rng = random.Random(seed)
    pages, labels = [], []
    for page in sample:
        found = blocks(page)
        marked = landmark_labels(found)
        if marked:
            pages.append(found)
            labels.append(marked)
        texts = [b.text for b in found if len(b.text) > 20] or ["Some words of a text."]
        for _ in range(layouts):
            made = blocks(made_page(texts, rng))
            pages.append([b._replace(text=b.text.replace(MAIN, "").strip() or "-") for b in made])
            labels.append([int(MAIN in b.text) for b in made])
    return pages, labels


def train(pages: DataFrame, html: str = "html", limit: int = SAMPLE_PAGES, seed: int = 42) -> Field:
    """A field from at most about ``limit`` pages of the table, chosen by a hash of their content."""
    known = pages.where(F.col(html).isNotNull()).select(F.col(html).alias("h"))
    rows = known.count()
    share = min(1.0, limit / rows) if rows else 0.0
    key = F.pmod(F.xxhash64("h", F.lit(seed)), F.lit(1 << 30))
    sample = sorted({r["h"] for r in known.where(key < int(share * (1 << 30))).distinct().collect()}) if rows else []
    found, labels = labelled_pages(sample)
    return fit([features(p) for p in found], labels)


class Extractor:
    """Main text of pages by one field."""

    def __init__(self, field: Field):
        self.weights, self.moves = field.weights, field.moves
        self.paths: dict = {}

    def text(self, page: str | None) -> str:
        found = blocks(page)
        get, paths, total = self.weights.get, self.paths, len(found)
        scores = []
        for i, b in enumerate(found):
            fixed = paths.get(b.path)
            if fixed is None:
                if len(paths) > 50_000:
                    paths.clear()
                fixed = paths[b.path] = sum(get(f, 0.0) for f in path_features(b.path)) + get("bias", 0.0)
            scores.append(fixed + sum(get(f, 0.0) for f in text_features(b, i, total)))
        return "\n".join(b.text for b, keep in zip(found, viterbi(scores, self.moves)) if keep)


def extract(pages: DataFrame, html: str = "html", limit: int = SAMPLE_PAGES) -> DataFrame:
    """Adds ``text``, the main text of every page, and ``n_chars``, its length in code points.

    Blocks of the main text are joined by one line break, in page order. Null and empty pages, and pages without
    main text, give an empty text. Every row stays and is worked on by itself; columns of the added names are
    replaced. Training takes a sample of the table (``limit`` pages), extraction every page as a whole.
    """
    keep = [c for c in pages.columns if c not in ("text", "n_chars")]
    source = pages.select(*keep)
    shared = pages.sparkSession.sparkContext.broadcast(train(pages, html, limit))
    schema = T.StructType(list(source.schema)).add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(shared.value)
        for batch in text_blocks(batches, html):
            texts = [extractor.text(p) for p in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return source.mapInArrow(run, schema)
