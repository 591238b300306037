"""Operator 8: main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks.  Each block is a vector: hashed tags, classes and ids of
its path, hashed words of its text, and a few sizes.  A bidirectional LSTM in numpy reads the whole
sequence, so every block is judged with the document around it, and says whether it is main text.

Training needs no hand-made labels: on a bounded sample of pages (``sample`` pages, picked by a hash
of page_id; of a longer page ``MAX_BLOCKS`` consecutive blocks from a hashed place, of a longer block
``BLOCK_CHARS`` characters from one, so ends of pages teach as beginnings do) blocks inside article-like elements are taken as text
and blocks in menus, headers, footers, asides, adverts, notices, forms and comments as not; blocks that
no rule names don't count.  Synthetic furniture is inserted and article elements are renamed, and the
path of some pages is hidden, so that words, sizes and context carry weight too.  The network
is trained at the start of the run, deterministically, and broadcast (some tens of thousands of weights).

Nulls and edge cases: a null or empty page, or one without text, gives an empty text; broken and
truncated markup is read as far as it goes; very long pages are read whole; repeated rows give equal
results; null page_id and url are carried; an empty table gives an empty result (nothing is trained);
only page_id, url and html are read.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import crc_rest, map_arrow, own_memory, table
from panelcast.llm.html_blocks import blocks

PATH_DIMS, TAG_DIMS, WORD_DIMS, SIZES, HIDDEN = 96, 32, 32, 6, 24
DIMS = PATH_DIMS + TAG_DIMS + WORD_DIMS + SIZES
SAMPLE, MAX_BLOCKS, BLOCK_CHARS, EPOCHS, BATCH, RATE = 240, 160, 4096, 6, 16, 0.01

# Names of page furniture and of main text in tags, classes, ids and roles.
FURNITURE = frozenset("""nav menu navbar navigation header masthead topbar footer aside sidebar ad ads advert advertisement sponsor sponsored banner promo
 cookie cookies consent gdpr notice alert popup modal overlay form search login signup subscribe newsletter comment comments reply replies disqus
 related recommended share social breadcrumb breadcrumbs pagination pager widget toolbar copyright legal button contentinfo complementary dialog""".split())
ARTICLE = frozenset("article main content post entry story articlebody body text".split())
EXTRA = (("aside", "sidebar"), ("div", "cookie notice"), ("div", "notice"), ("form", "subscribe"), ("form", "search"), ("section", "comments"), ("div", "comment"),
         ("div", "related"), ("div", "ad"), ("div", "banner"), ("header", ""), ("footer", ""), ("nav", "menu"), ("div", "share social"), ("div", "popup"), ("ul", "breadcrumb"))
RENAMED = (("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article"), ("div", "post entry"), ("section", "story"))

_WORD = re.compile(r"\w+")
_HASHES: dict[str, int] = {}
_PATHS: dict[tuple, np.ndarray] = {}


def path_vector(path: tuple) -> np.ndarray:
    if path not in _PATHS:
        if len(_PATHS) > 20_000:
            _PATHS.clear()
        v = np.zeros(PATH_DIMS + TAG_DIMS, np.float32)
        for tag, words in path:
            for w in (f"<{tag}>", *words):
                v[zlib.crc32(w.encode()) % PATH_DIMS] = 1
        for tag, words in path[-1:]:
            for w in (f"<{tag}>", *words):
                v[PATH_DIMS + zlib.crc32(w.encode(), 7) % TAG_DIMS] = 1
        _PATHS[path] = v
    return _PATHS[path]


def word_dims(words: Iterable[str]) -> np.ndarray:
    if len(_HASHES) > 300_000:
        _HASHES.clear()
    for w in set(words).difference(_HASHES):
        _HASHES[w] = zlib.crc32(w.encode()) % WORD_DIMS
    return np.fromiter(map(_HASHES.__getitem__, words), np.int64)


def vectors(page: list[tuple]) -> np.ndarray:
    """(blocks, DIMS) inputs of a page."""
    x = np.zeros((len(page), DIMS), np.float32)
    for i, (path, text, linked) in enumerate(page):
        x[i, :PATH_DIMS + TAG_DIMS] = path_vector(path)
        words = text.lower().split()
        x[i, PATH_DIMS + TAG_DIMS:-SIZES] = np.sqrt(np.bincount(word_dims(words), minlength=WORD_DIMS) / len(words))
        x[i, -SIZES:] = np.log1p(len(words)) / 5, np.log1p(len(text)) / 8, linked, text[-1] in ".!?:;", i / len(page), (len(page) - i) / len(page)
    return x


def weak_label(path: tuple) -> float:
    """1 for main text, 0 for furniture, nan where the names say nothing."""
    inside = False
    for tag, words in path:
        if tag == "body":
            continue
        names = {tag, *words}
        if names & FURNITURE and not (inside and names == {"header"}):
            return 0.0
        inside = inside or bool(names & ARTICLE)
    return 1.0 if inside else float("nan")


class BiLstm:
    """One LSTM in each direction and a logistic output on both states."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, seed: int = 11) -> "BiLstm":
        rng = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w["x" + d] = rng.normal(0, 0.15, (DIMS, 4 * HIDDEN)).astype(np.float32)
            w["h" + d] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            w["c" + d] = np.r_[np.ones(HIDDEN), np.zeros(3 * HIDDEN)].astype(np.float32)  # remember at first
        w["o"] = rng.normal(0, 0.15, 2 * HIDDEN).astype(np.float32)
        w["b"] = np.zeros(1, np.float32)
        return cls(w)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """States (time, page, HIDDEN) of one direction; padded steps leave the state as it is."""
        t_max, n = mask.shape
        gates_x = x @ self.w["x" + d] + self.w["c" + d]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((t_max, n, HIDDEN), np.float32)
        for t in range(t_max) if d == "f" else range(t_max - 1, -1, -1):
            g = gates_x[t] + h @ self.w["h" + d]
            f, i, o = (sigmoid(g[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            u = np.tanh(g[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            c_new = np.where(m, f * c + i * u, c)
            tc = np.tanh(c_new)
            h_new = np.where(m, o * tc, h)
            if trace is not None:
                trace.append((t, h, c, f, i, o, u, tc, m))
            h, c = h_new, c_new
            out[t] = h
        return out

    def probabilities(self, pages: list[np.ndarray], at_once: int = 20_000) -> list[np.ndarray]:
        """Probability of main text for every block; pages of similar length are run together."""
        out: list = [np.zeros(0, np.float32)] * len(pages)
        order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if len(pages[i])]
        while order:
            # from the longest page on, as many as fit
            take = max(1, at_once // len(pages[order[-1]]))
            group, order = order[-take:], order[:-take]
            x, mask = padded([pages[i] for i in group])
            p = sigmoid(np.concatenate([self._run(x, mask, "f"), self._run(x, mask, "b")], axis=2) @ self.w["o"] + self.w["b"])
            for k, i in enumerate(group):
                out[i] = p[:len(pages[i]), k]
        return out

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss over blocks with a label (back-propagation through time)."""
        traces = {"f": [], "b": []}
        both = np.concatenate([self._run(x, mask, d, traces[d]) for d in "fb"], axis=2)
        p = sigmoid(both @ self.w["o"] + self.w["b"])
        known = mask & ~np.isnan(y)
        dz = np.where(known, p - np.nan_to_num(y), 0).astype(np.float32) / max(1, known.sum())
        grad = {"o": np.einsum("tn,tnh->h", dz, both), "b": dz.sum(keepdims=True).reshape(1)}
        d_both = dz[:, :, None] * self.w["o"]
        for d, part in (("f", d_both[:, :, :HIDDEN]), ("b", d_both[:, :, HIDDEN:])):
            gx, gh = np.zeros((*mask.shape, 4 * HIDDEN), np.float32), np.zeros_like(self.w["h" + d])
            dh, dc = np.zeros((mask.shape[1], HIDDEN), np.float32), np.zeros((mask.shape[1], HIDDEN), np.float32)
            for t, h, c, f, i, o, u, tc, m in reversed(traces[d]):
                dh = dh + part[t]
                dh_in, dc_in = np.where(m, dh, 0), np.where(m, dc, 0)
                dct = dc_in + dh_in * o * (1 - tc * tc)
                g = np.concatenate([dct * c * f * (1 - f), dct * u * i * (1 - i), dh_in * tc * o * (1 - o), dct * i * (1 - u * u)], axis=1)
                gx[t] = g
                gh += h.T @ g
                dh = np.where(m, 0, dh) + g @ self.w["h" + d].T
                dc = np.where(m, dct * f, dc)
            grad["x" + d] = np.einsum("tnd,tng->dg", x, gx, optimize=True)
            grad["h" + d], grad["c" + d] = gh, gx.sum(axis=(0, 1))
        return grad


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(time, page, DIMS) inputs and the mask of real steps."""
    t = max(map(len, pages))
    x, mask = np.zeros((t, len(pages), DIMS), np.float32), np.zeros((t, len(pages)), bool)
    for k, v in enumerate(pages):
        x[:len(v), k], mask[:len(v), k] = v, True
    return x, mask


def varied(page: list[tuple], labels: list[float], others: list[str], rng: np.random.Generator) -> tuple[list[tuple], list[float]]:
    """A training copy of a page: article elements renamed, furniture with other texts inserted."""
    new = RENAMED[rng.integers(len(RENAMED))]
    swap = (new[0], tuple(new[1].split()))
    out = [(tuple(swap if e[0] in ("article", "main") else e for e in path), text, linked) for path, text, linked in page]
    labels = list(labels)
    for _ in range(rng.integers(0, 4)):
        tag, words = EXTRA[rng.integers(len(EXTRA))]
        at = int(rng.integers(0, len(out) + 1))
        base = out[min(at, len(out) - 1)][0][:-1] if out else ()
        inner = (("p", ()), ("li", ()), ("h2", ()), ("div", ()))[rng.integers(4)]
        path = (*base, (tag, tuple(words.split())), inner)
        for k in range(int(rng.integers(1, 5))):
            text = others[rng.integers(len(others))].split()
            text = " ".join(text[:int(rng.integers(2, 40))])
            if text:
                out.insert(at + k, (path, text, float(rng.random() < 0.3)))
                labels.insert(at + k, 0.0)
    return out, labels


def train(pages: list[list[tuple]], epochs: int = EPOCHS, seed: int = 11) -> BiLstm:
    """Fit a labeller to the blocks of sample pages by their weak labels (Adam, mean log loss)."""
    rng = np.random.default_rng(seed)
    seen = [(b, [weak_label(p) for p, _, _ in b]) for b in pages if b]
    seen = [s for s in seen if not np.isnan(s[1]).all()]
    net = BiLstm.fresh(seed)
    if not seen:
        return net
    others = [t for b, _ in seen for _, t, _ in b][:5000]
    mean = {k: np.zeros_like(v) for k, v in net.w.items()}
    var = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(seen))
        for lo in range(0, len(order), BATCH):
            xs, ys = [], []
            for i in order[lo:lo + BATCH]:
                page, labels = varied(*seen[i], others, rng)
                x = vectors(page)
                if rng.random() < 0.15:
                    x[:, :PATH_DIMS + TAG_DIMS] = 0
                xs.append(x)
                ys.append(np.array(labels, np.float32))
            x, mask = padded(xs)
            y = np.full(mask.shape, np.nan, np.float32)
            for k, v in enumerate(ys):
                y[:len(v), k] = v
            step += 1
            for k, g in net.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                var[k] = 0.999 * var[k] + 0.001 * g * g
                net.w[k] = (net.w[k] - RATE * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(var[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def window(page: list[tuple], place: int, most: int = MAX_BLOCKS, chars: int = BLOCK_CHARS) -> list[tuple]:
    """``most`` consecutive blocks of a page and ``chars`` consecutive characters of a block, wherever ``place`` falls."""
    def cut(x, size: int):
        at = place % max(1, len(x) - size + 1)
        return x[at:at + size]

    return [(path, cut(text, chars), linked) for path, text, linked in cut(page, most)]


def fit(pages: DataFrame, sample: int = SAMPLE) -> BiLstm:
    """Train on about ``sample`` pages, picked by a hash of page_id.  Pages are read whole where they lie;
    what travels of each is one window of blocks."""
    n, mod = pages.count(), 1 << 30
    drawn = pages.select(crc_rest("page_id", mod, "lstm").alias("at_"), crc_rest("page_id", mod, "place").alias("place_"), F.xxhash64("html").alias("h_"), "html")

    def run(batch: pa.RecordBatch) -> dict:
        got = [pickle.dumps(window(blocks(p), at)) for at, p in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())]
        return {"at_": batch.column(0), "h_": batch.column(2), "blocks": got}

    rows = map_arrow(drawn.where(F.col("at_") < min(mod, int(mod * sample / max(1, n)) + 1)), run, "at_ long, h_ long, blocks binary")
    return train([pickle.loads(r["blocks"]) for r in rows.sort("at_", "h_").limit(2 * sample).collect()])


def extract(pages: DataFrame, net: BiLstm, threshold: float = 0.5) -> DataFrame:
    """page_id, url, the main text, its length, and the numbers of blocks read and kept."""
    shared = pages.sparkSession.sparkContext.broadcast(net.w)

    def run(batch: pa.RecordBatch) -> dict:
        own_memory("html_lstm", _HASHES.clear)
        found = [blocks(p) for p in batch.column(2).to_pylist()]
        chosen = BiLstm(shared.value).probabilities([vectors(b) for b in found])
        texts = [" ".join(t for (_, t, _), p in zip(b, ps) if p >= threshold) for b, ps in zip(found, chosen)]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts],
                "n_blocks": [len(b) for b in found], "n_kept": [int((p >= threshold).sum()) for p in chosen]}

    return map_arrow(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long", slice_rows=256)


def op8_html_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages)).select("page_id", "url", "text", "n_chars", "n_blocks", "n_kept")
