"""Main text of web pages: a recurrent labeller over the page's leaf blocks.

Every block is read as its tag path and its words, both hashed, and a few
counts. A bidirectional LSTM (numpy) runs over the blocks of the whole page
in both directions, so each block is judged in the context of the document;
blocks labelled as article text are joined in page order.

Training. Pages carry no labels, so the labeller learns from generated
layouts (articles, menus, headers, sidebars, notices, adverts, forms,
comments, footers in many mark-ups) filled with text of a bounded sample of
the given pages, and from those sample pages themselves where semantic tags
tell the article from the rest. Training is one task on that sample; its size
is set by parameters and does not grow with the input.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .htmlblocks import Block, leaf_blocks
from .store import in_share, mapped, small_batches, stored
from .words import U, blocks, texts_of, words_of


@dataclass(frozen=True)
class ExtractParams:
    path_slots: int = 256
    own_slots: int = 128  # for the innermost element
    word_slots: int = 32
    hidden: int = 24
    sample_pages: int = 200
    sample_page_chars: int = 100_000  # training draws from the pages up to this length; all pages are extracted, whole
    made_pages: int = 1200
    epochs: int = 14
    batch: int = 32
    rate: float = 0.008
    cells: int = 6000  # padded blocks that are labelled at once
    seed: int = 5

    @property
    def width(self) -> int:
        return self.path_slots + self.own_slots + self.word_slots + 10


_CLOSERS = tuple(".!?…:;\"'”»)")


def _slot(token: str, n: int) -> tuple[int, float]:
    h = crc32(token.encode("utf-8", "replace"))
    return h % n, 1.0 if h & 0x40000000 else -1.0


class BlockReader:
    """Feature rows of blocks; the vectors of paths are kept, as pages repeat them."""

    def __init__(self, p: ExtractParams):
        self.p = p
        self._paths: dict[tuple, np.ndarray] = {}

    def _path(self, path: tuple) -> np.ndarray:
        found = self._paths.get(path)
        if found is None:
            found = np.zeros(self.p.path_slots + self.p.own_slots, np.float32)
            for element in path:
                for token in element:
                    i, sign = _slot(token, self.p.path_slots)
                    found[i] = np.clip(found[i] + sign, -2, 2)
            for token in path[-1] if path else ():
                i, sign = _slot(token, self.p.own_slots)
                found[self.p.path_slots + i] = sign
            if len(self._paths) < 20_000:
                self._paths[path] = found
        return found

    def rows(self, page: list[Block]) -> np.ndarray:
        p, n = self.p, len(page)
        out = np.zeros((n, p.width), np.float32)
        if not n:
            return out
        at = p.path_slots + p.own_slots
        w = words_of(pa.array([b.text for b in page]), lower=True)
        row = w.row_of()
        slots = (w.hashes >> U(59)).astype(np.int64) % p.word_slots
        counts = np.bincount(row * p.word_slots + slots, minlength=n * p.word_slots).reshape(n, p.word_slots)
        out[:, at : at + p.word_slots] = counts / np.maximum(w.counts, 1)[:, None]
        for i, b in enumerate(page):
            out[i, :at] = self._path(b.path)
            size = len(b.text)
            tag = b.path[-1][0] if b.path else ""
            out[i, at + p.word_slots :] = (
                np.log1p(size) / 6, np.log1p(w.counts[i]) / 5, b.link_share, b.text.endswith(_CLOSERS), b.text.count(",") * 10 / (size + 10),
                i / n, (n - i) / n, tag[:1] == "h" and tag[1:].isdigit(), tag == "li", tag == "p",
            )
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(x: np.ndarray, w: dict[str, np.ndarray], keep: bool):
    """Both LSTMs over (side, pages, steps, features): hidden states (side, pages, steps, hidden), and what the gradient needs if asked."""
    sides, pages, steps, _ = x.shape
    hidden = w["u"].shape[1]
    driven = (np.matmul(x.reshape(sides, pages * steps, -1), w["w"]) + w["b"]).reshape(sides, pages, steps, 4 * hidden).transpose(2, 0, 1, 3).copy()
    h, c = np.zeros((sides, pages, hidden), np.float32), np.zeros((sides, pages, hidden), np.float32)
    out, past = np.zeros((steps, sides, pages, hidden), np.float32), []
    for t in range(steps):
        z = driven[t] + np.matmul(h, w["u"])
        gates = _sigmoid(z[..., : 3 * hidden])
        i, f, o = gates[..., :hidden], gates[..., hidden : 2 * hidden], gates[..., 2 * hidden :]
        g = np.tanh(z[..., 3 * hidden :])
        before = c
        c = f * c + i * g
        squashed = np.tanh(c)
        if keep:
            past.append((h, before, i, f, o, g, squashed))
        h = o * squashed
        out[t] = h
    return out.transpose(1, 2, 0, 3), past


def _back(x, w, past, grad_out, grads):
    sides, pages, steps, _ = x.shape
    hidden = w["u"].shape[1]
    dz = np.zeros((steps, sides, pages, 4 * hidden), np.float32)
    dh, dc = np.zeros((sides, pages, hidden), np.float32), np.zeros((sides, pages, hidden), np.float32)
    back = w["u"].transpose(0, 2, 1).copy()
    toward = grad_out.transpose(2, 0, 1, 3)
    for t in range(steps - 1, -1, -1):
        h, before, i, f, o, g, squashed = past[t]
        dh = dh + toward[t]
        dc = dc + dh * o * (1 - squashed * squashed)
        d = dz[t]
        d[..., :hidden] = dc * g * i * (1 - i)
        d[..., hidden : 2 * hidden] = dc * before * f * (1 - f)
        d[..., 2 * hidden : 3 * hidden] = dh * squashed * o * (1 - o)
        d[..., 3 * hidden :] = dc * i * (1 - g * g)
        dh = np.matmul(d, back)
        dc = dc * f
    flat = dz.transpose(1, 2, 0, 3).reshape(sides, pages * steps, 4 * hidden)
    states = np.stack([p[0] for p in past]).transpose(1, 3, 0, 2).reshape(sides, hidden, steps * pages)
    grads["u"] = np.matmul(states, dz.transpose(1, 0, 2, 3).reshape(sides, steps * pages, 4 * hidden))
    grads["w"] = np.matmul(x.reshape(sides, pages * steps, -1).transpose(0, 2, 1), flat)
    grads["b"] = flat.sum(axis=1, keepdims=True)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(features in page order and reversed, mask), padded at the end."""
    steps = max(len(r) for r in pages)
    x = np.zeros((2, len(pages), steps, pages[0].shape[1]), np.float32)
    mask = np.zeros((len(pages), steps), bool)
    for k, rows in enumerate(pages):
        x[0, k, : len(rows)], x[1, k, : len(rows)], mask[k, : len(rows)] = rows, rows[::-1], True
    return x, mask


def _turned(states: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """States of the reverse run in page order (its own inverse)."""
    out = np.zeros_like(states)
    for k, n in enumerate(mask.sum(axis=1)):
        out[k, :n] = states[k, :n][::-1]
    return out


@dataclass
class Labeller:
    weights: dict[str, np.ndarray]
    p: ExtractParams

    def scores(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of article text for every block of every page."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and (to + 1 - at) * len(pages[order[to]]) <= self.p.cells:
                to += 1
            some = order[at:to]
            x, mask = _padded([pages[k] for k in some])
            states, _ = _run(x, self.weights, False)
            score = _sigmoid(np.concatenate([states[0], _turned(states[1], mask), x[0]], axis=2) @ self.weights["out"] + self.weights["bias"])
            for k, row, keep in zip(some, score, mask, strict=True):
                out[k] = row[keep]
            at = to
        return out


def fit_labeller(pages: list[np.ndarray], labels: list[np.ndarray], p: ExtractParams) -> Labeller:
    """Train on pages of block features with 0/1 labels (Adam, logistic loss, backpropagation through the whole page)."""
    rng = np.random.default_rng(p.seed)
    h = p.hidden

    def start(rows, columns):
        return (rng.standard_normal((rows, columns)) / np.sqrt(rows)).astype(np.float32)

    w = {"out": np.zeros(2 * h + p.width, np.float32), "bias": np.zeros(1, np.float32)}
    w["out"][: 2 * h] = rng.standard_normal(2 * h) * 0.2
    w["w"] = np.stack([start(p.width, 4 * h) for _ in range(2)])
    w["u"] = np.stack([start(h, 4 * h) for _ in range(2)])
    w["b"] = np.zeros((2, 1, 4 * h), np.float32)
    w["b"][:, :, h : 2 * h] = 1.0
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    filled = [k for k in range(len(pages)) if len(pages[k])]
    steps = 0
    rounds = p.epochs * max(1, -(-len(filled) // p.batch))
    for _ in range(p.epochs):
        # pages of similar length together, in random order of the batches
        ranked = sorted(filled, key=lambda k: len(pages[k]) + rng.random() * 6)
        groups = [ranked[a : a + p.batch] for a in range(0, len(ranked), p.batch)]
        for g in rng.permutation(len(groups)):
            some = groups[g]
            x, mask = _padded([pages[k] for k in some])
            y = np.zeros(mask.shape, np.float32)
            for row, k in zip(y, some, strict=True):
                row[: len(labels[k])] = labels[k]
            states, past = _run(x, w, True)
            seen = np.concatenate([states[0], _turned(states[1], mask), x[0]], axis=2)
            error = np.where(mask, _sigmoid(seen @ w["out"] + w["bias"]) - y, 0).astype(np.float32) / mask.sum()
            grads = {"out": np.einsum("bt,btd->d", error, seen), "bias": np.array([error.sum()], np.float32)}
            toward = error[:, :, None] * w["out"]
            _back(x, w, past, np.stack([toward[:, :, :h], _turned(toward[:, :, h : 2 * h], mask)]), grads)
            steps += 1
            rate = p.rate * min(1.0, 2.0 * (1 - steps / (rounds + 1)))
            for k in w:
                g_ = np.clip(grads[k], -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g_
                second[k] = 0.99 * second[k] + 0.01 * g_ * g_
                w[k] = (w[k] - rate * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.99**steps)) + 1e-7)).astype(np.float32)
    return Labeller(w, p)


# Words that pages use in class and id attributes for the parts of their layout.
ARTICLE_WORDS = "article article-body article-content body content entry entry-content main main-content news page-content post post-body post-content story story-body text".split()
OTHER_WORDS = {
    "menu": "breadcrumb breadcrumbs links main-menu menu nav nav-bar navbar navigation pagination site-nav tabs toc-links top-menu".split(),
    "header": "banner branding head header logo masthead page-header site-header site-title tagline top topbar".split(),
    "sidebar": "aside latest most-read popular recommended related related-posts see-also sidebar sidebar-right teaser trending widget widgets".split(),
    "notice": "alert announcement consent cookie cookie-banner cookies disclaimer gdpr message modal newsletter notice notification overlay paywall popup privacy promo-bar subscribe warning".split(),
    "advert": "ad ad-box ad-slot ads adsbygoogle advert advertisement banner-ad promo promotion sponsor sponsored".split(),
    "form": "contact-form form login login-form newsletter-form search search-form signup".split(),
    "comments": "comment comment-body comment-list comments discussion feedback replies reply responses thread user-comments".split(),
    "footer": "bottom colophon copyright credits foot footer legal page-footer site-footer site-info".split(),
    "share": "author byline meta post-meta share sharing social social-links tags".split(),
}
OTHER_TAGS = {"menu": ("nav", "ul", "div"), "header": ("header", "div"), "sidebar": ("aside", "div", "section"), "notice": ("div", "section", "aside", "p"), "advert": ("div", "aside", "ins", "section"),
              "form": ("form",), "comments": ("section", "div", "ol"), "footer": ("footer", "div"), "share": ("div", "p", "ul")}
SEMANTIC = {"menu": "nav", "header": "header", "sidebar": "aside", "form": "form", "footer": "footer"}


class PageMaker:
    """Generated training pages; elements carry data-label="1" (article) or "0"."""

    def __init__(self, paragraphs: list[str], rng: np.random.Generator):
        self.paragraphs = [p for p in paragraphs if p] or ["Text of a page.", "More of it, in a longer sentence than before."]
        self.rng = rng

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def words(self, low: int, high: int) -> str:
        source = self.pick(self.paragraphs).split()
        n = int(self.rng.integers(low, high + 1))
        at = int(self.rng.integers(max(1, len(source) - n + 1)))
        return " ".join(source[at : at + n]).replace("&", "&amp;").replace("<", "&lt;")

    def prose(self) -> str:
        return self.words(4, 25) if self.rng.random() < 0.4 else self.words(25, 120) if self.rng.random() < 0.7 else self.words(1, 6)

    def named(self, tag: str, words: list[str], label: str, sure: float = 0.9) -> str:
        classes = [self.pick(words)] if self.rng.random() < sure else []
        if self.rng.random() < 0.25:
            classes.append(self.pick(["box", "clearfix", "col-8", "container", "grid", "inner", "left", "row", "wide", "x" + str(self.rng.integers(100))]))
        name = self.pick(["class", "class", "id"])
        return f'<{tag} data-label="{label}"' + (f' {name}="{" ".join(classes)}"' if classes else "") + ">"

    def link(self) -> str:
        return f'<a href="/{self.rng.integers(999)}">{self.words(1, 4)}</a>'

    def other(self, kind: str) -> str:
        tag = self.pick(OTHER_TAGS[kind])
        sure = 0.6 if SEMANTIC.get(kind) == tag else 1.0
        inside = []
        for _ in range(int(self.rng.integers(1, 6))):
            r = self.rng.random()
            if kind in ("menu", "share") or (kind in ("sidebar", "footer", "header") and r < 0.4):
                items = "".join(f"<li>{self.link()}</li>" for _ in range(int(self.rng.integers(2, 8))))
                inside.append(items if tag in ("ul", "ol") else f"<ul>{items}</ul>" if self.rng.random() < 0.7 else " ".join(self.link() for _ in range(4)))
            elif kind == "comments":
                body = f"<p>{self.prose()}</p>"
                inside.append(f'<li class="comment">{body}</li>' if tag == "ol" else f'<div class="{self.pick(OTHER_WORDS["comments"])}"><h4>{self.words(1, 2)}</h4>{body}</div>')
            elif kind == "form":
                inside.append(f"<label>{self.words(1, 3)}</label><input name=a><p>{self.words(3, 15)}</p>")
            elif r < 0.25:
                inside.append(f"<h{self.rng.integers(1, 5)}>{self.words(1, 8)}</h3>")
            elif r < 0.6 or tag == "p":
                inside.append(self.words(3, 30))
            else:
                inside.append(f"<p>{self.prose()}</p>")
        if kind == "footer" and self.rng.random() < 0.6:
            inside.append(f"&copy; {self.rng.integers(1999, 2030)} &middot; {self.words(1, 12)}")
        return self.named(tag, OTHER_WORDS[kind], "0", sure) + "".join(inside) + f"</{tag}>"

    def article(self) -> str:
        kind = self.rng.random()
        if kind < 0.45:
            opened, close = self.named("article", ARTICLE_WORDS, "1", 0.4), "</article>"
        elif kind < 0.6:
            opened, close = self.named("main", ARTICLE_WORDS, "1", 0.4), "</main>"
        elif kind < 0.92:
            tag = self.pick(["div", "div", "section"])
            opened, close = self.named(tag, ARTICLE_WORDS, "1", 1.0), f"</{tag}>"
        else:
            opened, close = self.named("div", ARTICLE_WORDS, "1", 0.0), "</div>"
        parts = [f"<h1>{self.words(2, 12)}</h1>"] if self.rng.random() < 0.85 else []
        for _ in range(int(self.rng.integers(1, 14))):
            r = self.rng.random()
            if r < 0.62:
                parts.append(f"<p>{self.prose()}</p>")
            elif r < 0.7:
                parts.append(f"<p><b>{self.words(3, 30)}<br>")
            elif r < 0.76:
                parts.append(f"<h{self.rng.integers(2, 5)}>{self.words(1, 8)}</h2>")
            elif r < 0.81:
                parts.append(f"<p>{self.words(5, 20)} {self.link()} {self.words(5, 20)}</p>")
            elif r < 0.85:
                parts.append("<ul>" + "".join(f"<li>{self.words(1, 15)}</li>" for _ in range(int(self.rng.integers(1, 6)))) + "</ul>")
            elif r < 0.88:
                parts.append(f"<blockquote><p>{self.words(5, 40)}</p></blockquote>")
            elif r < 0.9:
                parts.append("<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(3)) + "</table>")
            else:
                parts.append(self.other(self.pick(["advert", "share", "sidebar", "notice", "form"])))
        if self.rng.random() < 0.15:
            parts.append(self.other("comments"))
        return opened + "".join(parts) + close

    def page(self) -> str:
        top = [k for k in ("notice", "header", "menu", "advert", "form", "menu") if self.rng.random() < 0.5]
        below = [k for k in ("share", "comments", "sidebar", "advert", "form", "notice", "menu", "footer") if self.rng.random() < 0.45]
        self.rng.shuffle(top)
        parts = [self.other(k) for k in top]
        if self.rng.random() < 0.3:
            parts.append(self.other("sidebar"))
        parts.append(self.article())
        parts += [self.other(k) for k in below]
        inner = "".join(parts)
        if self.rng.random() < 0.4:
            inner = f'<div class="{self.pick(["container", "layout", "page", "row", "site", "wrap", "wrapper"])}" data-label="0">{inner}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title></head><body>{inner}</body></html>"


_OUTSIDE = {w for words in OTHER_WORDS.values() for x in words for w in x.split("-")} - {w for x in ARTICLE_WORDS for w in x.split("-")}


def semantic_labels(page: list[Block]) -> np.ndarray | None:
    """Labels of a real page whose article tag (else main tag) tells its article; None if it has neither."""
    inside = np.zeros(len(page), np.float32)
    for wanted in ("article", "main"):
        for i, b in enumerate(page):
            tags = [e[0] for e in b.path]
            if wanted in tags:
                rest = b.path[tags.index(wanted) + 1 :]
                odd = any(e[0] in ("nav", "aside", "footer", "header", "form") or any(t[1:] in _OUTSIDE for t in e[1:]) for e in rest)
                inside[i] = not odd
        if inside.any():
            return inside
    return None


def labeller_of(sample: list[str], p: ExtractParams) -> Labeller:
    """Train on ``made_pages`` generated pages filled with the sample's text, and on the sample where tags label it."""
    real = [leaf_blocks(t) for t in sorted(sample)]
    maker = PageMaker([b.text for page in real for b in page], np.random.default_rng(p.seed))
    made = [leaf_blocks(maker.page()) for _ in range(p.made_pages)]
    reader = BlockReader(p)
    rows = [reader.rows(page) for page in made]
    labels = [np.array([b.label == "1" for b in page], np.float32) for page in made]
    for page in real:
        known = semantic_labels(page)
        if known is not None:
            rows.append(reader.rows(page))
            labels.append(known)
    return fit_labeller(rows, labels, p)


def train_labeller(pages: DataFrame, p: ExtractParams = ExtractParams()) -> Labeller:
    """``labeller_of`` about ``sample_pages`` whole pages of at most ``sample_page_chars`` characters each (chosen by a hash), trained in one task on that bounded sample."""
    texts = pages.select(F.col("html").cast("string").alias("text")).where((F.col("text") != "") & (F.char_length("text") <= p.sample_page_chars))
    share = min(1.0, p.sample_pages / max(1, texts.count()))
    chosen = texts.where(in_share(F.xxhash64("text", F.lit(p.seed)), share)).dropDuplicates()

    def run(batches):
        sample = [t for b in batches for t in texts_of(b.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(labeller_of(sample, p).weights)], pa.binary())], ["weights"])

    with small_batches(pages.sparkSession):
        got = mapped(chosen.repartition(1), run, "weights binary").collect()
    return Labeller(pickle.loads(got[0]["weights"]), p) if got else labeller_of([], p)


def main_texts(pages: DataFrame, p: ExtractParams = ExtractParams()) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) for every row of ``pages(page_id, url, html)``.

    text joins the article's blocks by line breaks, n_chars counts its code
    points, n_blocks the blocks of the page. Null or empty html gives an empty
    text. Repeated rows are extracted each; page_id and url are passed through.
    """
    model = pages.sparkSession.sparkContext.broadcast(train_labeller(pages, p))

    def run(batches):
        reader = BlockReader(p)
        for b in blocks(batches):
            found = [leaf_blocks(t) if t else [] for t in texts_of(b.column(2))]
            scores = model.value.scores([reader.rows(page) for page in found])
            texts = ["\n".join(x.text for x, s in zip(page, score, strict=True) if s >= 0.5) for page, score in zip(found, scores, strict=True)]
            texts = [t.encode("utf-8", "replace").decode() for t in texts]  # &#xD800; and the like are no characters
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(page) for page in found], pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks"],
            )

    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("text"))
    return stored(mapped(own, run, "page_id long, url string, text string, n_chars long, n_blocks long"), "main_texts")
