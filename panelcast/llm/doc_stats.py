"""Statistics of whole texts that the quality operators share.

Words are runs of bytes other than space and 0x09-0x0D.  A null or empty text has all
statistics 0.  Counts are exact and cover the whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import map_arrow, own_memory

# Characters of markup and tables, white space, word window of a repeat.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_unique_words",
          "top_word", "n_upper", "n_digits", "n_marks", "n_bytes", "n_long_words", "n_sentences")
#: ratio -> (numerator, denominator); the inputs of thresholds and rules
RATIOS = {
    "symbol_ratio": ("n_symbols", "word_chars"), "upper_ratio": ("n_upper", "word_chars"), "digit_ratio": ("n_digits", "word_chars"),
    "mark_ratio": ("n_marks", "n_words"), "dup_line_ratio": ("n_dup_lines", "n_lines"), "repeat_ratio": ("n_repeat_words", "n_words"),
    "unique_ratio": ("n_unique_words", "n_words"), "top_ratio": ("top_word", "n_words"), "mean_word": ("word_chars", "n_words"),
    "long_ratio": ("n_long_words", "n_words"), "words_per_line": ("n_words", "n_lines"), "words_per_sentence": ("n_words", "n_sentences"),
}


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` (a power of two) words that occur at least twice.

    Windows are compared exactly: each doubling names the pairs of names by their rank."""
    n = len(ids)
    if n <= window:
        return 0
    names, width = ids, 1
    while width < window:
        key = names[:-width].astype(np.int64) * (int(names.max()) + 1) + names[width:]
        _, names, counts = np.unique(key, return_inverse=True, return_counts=True)
        width *= 2
        if counts.max() < 2:
            return 0
    starts = counts[names] > 1
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(starts)
    edge[at] += 1
    edge[at + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one text."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return (0,) * (len(COUNTS) - 3) + (len(raw), 0, 0)
    by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    continued = int(by[0x80:0xC0].sum())
    word_chars = len(raw) - continued - sum(int(by[b]) for b in SPACE)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    return (
        len(words), word_chars, sum(int(by[b]) for b in SYMBOLS), len(lines) - len(set(lines)), repeated_words(ids), len(lines), len(seen),
        int(np.bincount(ids).max()), int(by[65:91].sum()), int(by[48:58].sum()), int(by[33] + by[63]), len(raw),
        sum(len(w) > 20 for w in words), int(by[46] + by[33] + by[63]),
    )


def with_stats(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source"), inside: bool = False) -> DataFrame:
    """``keep`` columns (with ``inside`` the text is a field of the first, a struct), the COUNTS (long) and the RATIOS (double, 0 where the denominator is 0)."""
    from pyspark.sql.types import LongType, StructType

    schema = StructType()
    for c in keep:
        schema = schema.add(c, docs.schema[c].dataType)
    for c in COUNTS:
        schema = schema.add(c, LongType())

    def run(batch: pa.RecordBatch) -> dict:
        own_memory("doc_stats", lambda: None)
        texts = pc.struct_field(batch.column(0), text) if inside else batch.column(len(keep))
        cols = dict(zip(COUNTS, zip(*map(text_stats, texts.to_pylist()))))
        return {c: batch.column(i) for i, c in enumerate(keep)} | cols

    out = map_arrow(docs.select(*keep, *([] if inside else [F.col(text).alias("text_")])), run, schema, slice_rows=500)
    return out.withColumns({r: F.when(F.col(d) > 0, F.col(n) / F.col(d)).otherwise(0.0) for r, (n, d) in RATIOS.items()})
