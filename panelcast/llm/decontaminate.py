"""Operator 4: benchmark decontamination under edit distance.

An item of ``n`` words is found in a document when some window of it is within ``floor(edits * n)`` word
edits (insertions, deletions, substitutions; A-Z lowered).  Windows of each item's size start at
every word of every document.

1. A lossless count filter: ``k`` edits change at most ``2 k`` of an item's ``n - 1`` word pairs, so a
   window with fewer than ``n - 1 - 2 k`` pairs of benchmark words is no candidate.
2. The other windows are embedded by CGK random walks, which turn edit distance into Hamming
   distance.  Bit sampling (here: word sampling) puts windows and items into LSH tables;
   ``WALKS * TABLES`` repetitions reach the target recall (see tests: above 0.95 at the largest
   distance).  Windows at several neighbouring starts meet the same item, which raises it further.
   The tables of a length class are one sorted array of bucket keys, so a window costs one lookup per table,
   however many items there are.
3. Candidates are verified by the exact edit distance.

Items under ``min_words`` words have no edit budget: they are found wherever their words stand, exactly.

The benchmark is the query set: it is cut into blocks of at most ``block_bytes`` of text, and each block is
broadcast and held against all documents.  Documents are not shuffled.

Nulls and edge cases: a null or empty text holds nothing; items that are null or without words match
nothing; items with equal texts are found each; of equally distant places the first is given; a null item_id is carried as it is; repeated document rows give repeated results; empty tables
give an empty result; only doc_id, text and item_id, text are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import cgk
from panelcast.llm.common import map_arrow, table
from panelcast.llm.shingles import mixed, word_hashes

EDITS, MIN_WORDS, RATIO, BLOCK_BYTES, STEPS_PER_WORD = 0.2, 5, 1.12, 4 << 20, 1.6
BLOCK_WINDOWS = 1 << 14        # windows looked up at once
SCHEMA = "doc_id long, item_id long, distance long, item_words long, start_word long, n_words long"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def word_pairs(words: np.ndarray) -> np.ndarray:
    """A hash of each word with the next one."""
    return mixed(words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:])


class Known:
    """Membership in a fixed set of hashes; a bit table turns most others away."""

    def __init__(self, values: np.ndarray):
        self.values = np.sort(values)
        bits = min(26, max(20, len(values).bit_length() + 3))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(values >> self.shift).astype(np.int64)] = True

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = self.table[(x >> self.shift).astype(np.int64)]
        at = np.flatnonzero(out)
        place = np.minimum(np.searchsorted(self.values, x[at]), len(self.values) - 1)
        out[at] = self.values[place] == x[at]
        return out


class Buckets:
    """Hash buckets as one sorted array of keys, with the number of the entry behind each."""

    def __init__(self, keys: np.ndarray, entries: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.entries = keys[order], entries[order]
        self.known = Known(self.keys)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``keys``, entry) of everything that shares a bucket."""
        at = np.flatnonzero(self.known(keys))
        first = np.searchsorted(self.keys, keys[at])
        n = np.searchsorted(self.keys, keys[at], side="right") - first
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.entries[np.repeat(first, n) + within]


@dataclass
class LengthClass:
    """Different items of similar length with their LSH tables."""
    items: list                # word hashes
    span: int                  # words a match may cover
    need: int                  # known word pairs that every match holds
    steps: int
    coords: np.ndarray = field(default=None)
    buckets: Buckets = field(default=None)


class Matcher:
    """All items of a block, ready to be held against documents."""

    def __init__(self, items: list[tuple], edits: float = EDITS, min_words: int = MIN_WORDS):
        self.ids: dict[bytes, list] = {}           # items of equal words share one entry
        for i, t in items:
            if words := words_of(t):
                self.ids.setdefault(word_hashes(words).tobytes(), []).append(i)
        hashed = sorted((np.frombuffer(w, np.uint64) for w in self.ids), key=len)
        self.short: dict[int, Buckets] = {}
        self.brief = [w for w in hashed if len(w) < min_words]
        for n in sorted({len(w) for w in self.brief}):
            at = [k for k, w in enumerate(self.brief) if len(w) == n]
            self.short[n] = Buckets(cgk.chained(np.stack([self.brief[k] for k in at], axis=1), 0), np.array(at))
        hashed = [w for w in hashed if len(w) >= min_words]
        self.edits = edits
        self.pairs = Known(np.unique(np.concatenate([word_pairs(w) for w in hashed])) if hashed else np.zeros(1, np.uint64))
        self.classes: list[LengthClass] = []
        for w in hashed:
            n = len(w)
            if not self.classes or n > RATIO * len(self.classes[-1].items[0]):
                self.classes.append(LengthClass([], 0, n, 0))
            c = self.classes[-1]
            c.items.append(w)
            c.span = n + self.most(n)
            c.need = min(c.need, n - 1 - 2 * self.most(n))
        for c in self.classes:
            c.steps = max(1, int(STEPS_PER_WORD * len(c.items[0])))
            c.coords = cgk.sampled(c.steps)
            flat, starts = self._padded(c.items, c.steps)
            keys = np.stack([cgk.bucket_keys(cgk.embed(flat, starts, c.steps, k), c.coords[k], k) for k in range(cgk.WALKS)])
            c.buckets = Buckets(keys.ravel(), np.tile(np.arange(len(c.items)), keys.size // len(c.items)))
        self.span = max((c.span for c in self.classes), default=0)
        self.pad = max((c.steps for c in self.classes), default=0) + self.span + min_words + 1

    def most(self, n: int) -> int:
        return int(self.edits * n)

    @staticmethod
    def _padded(texts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
        """One array with ``pad`` blanks (0) behind each text, and where the texts start."""
        starts = np.cumsum([0, *(len(w) + pad for w in texts)])
        flat = np.zeros(starts[-1], np.uint64)
        for s, w in zip(starts, texts):
            flat[s:s + len(w)] = w
        return flat, starts[:-1]

    def __call__(self, texts: list[str | None]) -> list[tuple[int, int | None, int, int, int, int]]:
        """(text number, item_id, distance, item_words, start_word, n_words): the best match of every pair."""
        words = [word_hashes(w) if (w := words_of(t)) else np.zeros(0, np.uint64) for t in texts]
        if not self.ids or not any(map(len, words)):
            return []
        flat, starts = self._padded(words, self.pad)
        ends = starts + np.array([len(w) for w in words])
        best: dict[tuple[int, bytes], tuple] = {}

        def offer(at: int, item: np.ndarray, d: int, n: int):
            doc = int(np.searchsorted(starts, at, side="right")) - 1
            key, start = (doc, item.tobytes()), at - int(starts[doc])
            if key not in best or (d, start) < best[key][:2]:
                best[key] = (d, start, len(item), n)

        for n, buckets in self.short.items():
            here = np.flatnonzero(flat[:len(flat) - n + 1])
            for at, k in self._first(*buckets(cgk.chained(flat[here[:, None] + np.arange(n)].T, 0)), here, starts):
                if np.array_equal(flat[at:at + n], self.brief[k]):
                    offer(at, self.brief[k], 0, n)
        for c, here in self._windows(flat):
            hits = [np.zeros(0, np.int64)]
            for k in range(cgk.WALKS):
                keys = cgk.bucket_keys(cgk.embed(flat, here, c.steps, k), c.coords[k], k)
                for row in keys:
                    w, i = c.buckets(row)
                    if len(w):
                        hits.append(np.unique(w * len(c.items) + i))
            for hit in np.unique(np.concatenate(hits)).tolist():
                w, i = divmod(hit, len(c.items))
                at, item = int(here[w]), c.items[i]
                doc = int(np.searchsorted(starts, at, side="right")) - 1
                limit = self.most(len(item))
                d, n = cgk.edit_distance(item, flat[at:ends[doc]], limit)
                if d <= limit:
                    offer(at, item, d, n)
        return [(doc, i, d, size, start, n) for (doc, item), (d, start, size, n) in best.items() for i in self.ids[item]]

    @staticmethod
    def _first(place: np.ndarray, entry: np.ndarray, here: np.ndarray, starts: np.ndarray):
        """The first place of every entry in every text."""
        doc = np.searchsorted(starts, here[place], side="right") - 1
        _, at = np.unique(np.stack([doc, entry]), axis=1, return_index=True) if len(place) else (None, [])
        return [(int(here[place[k]]), int(entry[k])) for k in at]

    def _windows(self, flat: np.ndarray):
        """Blocks of (length class, window starts) that pass the count filter."""
        if not self.classes:
            return
        size = len(flat)
        sums = np.r_[0, np.cumsum(self.pairs(word_pairs(flat))), 0]
        sums[-1] = sums[-2]
        least = min(c.need for c in self.classes)
        # pairs that begin in the first span - 1 words of the window
        count = sums[np.minimum(np.arange(size) + self.span - 1, size)] - sums[:-1]
        windows = np.flatnonzero((flat != 0) & (count >= least))
        for c in self.classes:
            here = windows[sums[np.minimum(windows + c.span - 1, size)] - sums[windows] >= c.need]
            for at in range(0, len(here), BLOCK_WINDOWS):
                yield c, here[at:at + BLOCK_WINDOWS]


_READY: dict[int, Matcher] = {}


def matcher(items: list[tuple], edits: float, min_words: int) -> Matcher:
    """The matcher of a block, built once per process."""
    key = hash((tuple(items), edits, min_words))
    if key not in _READY:
        _READY.clear()
        _READY[key] = Matcher(items, edits, min_words)
    return _READY[key]


def item_blocks(benchmark: DataFrame, block_bytes: int):
    """The items in broadcast blocks of about ``block_bytes`` of text, dealt by a hash."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.length("text") > 0)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == k).sort("item_id", "text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast([tuple(r) for r in block])


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, min_words: int = MIN_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per document and item found in it, with the best distance and its place (in words)."""
    out = None
    for shared in item_blocks(benchmark, block_bytes):
        def run(batch: pa.RecordBatch, shared=shared) -> dict:
            got = matcher(shared.value, edits, min_words)(batch.column(1).to_pylist())
            doc, item, *rest = zip(*got) if got else ((),) * 6
            names = ("distance", "item_words", "start_word", "n_words")
            return {"doc_id": batch.column(0).take(pa.array(doc, pa.int64())), "item_id": list(item)} | dict(zip(names, map(list, rest)))

        found = map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SCHEMA)
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, min_words: int = MIN_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no item; decided where the rows are, without a join."""
    columns = docs.columns
    for shared in item_blocks(benchmark, block_bytes):
        def run(batch: pa.RecordBatch, shared=shared) -> dict:
            got = matcher(shared.value, edits, min_words)(pc.struct_field(batch.column(0), "text").to_pylist())
            keep = np.ones(batch.num_rows, bool)
            keep[[g[0] for g in got]] = False
            return {"row_": batch.column(0).filter(pa.array(keep))}

        packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row_"))
        left = map_arrow(packed, run, packed.schema)
        docs = left.select(*[F.col("row_").getField(c).alias(c) for c in columns])
    return docs


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of ``benchmark`` found in ``documents``: one row per contaminated document and item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
