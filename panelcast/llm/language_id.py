"""Operator 9: language identification by compression.

For each language a raw-content dictionary for zstandard is filled with text of that language.  A text
is cut into pieces that fit the dictionaries' reach, each piece is compressed with every dictionary, and
the language with the smallest total is chosen.  Texts whose two best totals lie close together are
rejected (``rejected``): their ``lang`` is ``und`` while ``lang_pred`` still names the smallest.

The dictionaries are fitted on a bounded, documented sample: ``dict_bytes`` of normalised text per
language, from rows picked by a hash of doc_id and taken in the order of that hash, at most ``sample_chars``
characters of each from a hashed place anywhere in the text.  Everything else reads whole texts.

Nulls and edge cases: a null text or one without a letter is ``und`` with score 0, and rejected; rows
without lang teach nothing; if no row teaches, every row is ``und``.  Ties between totals go to the
language with more rows, then to the first by name.  Repeated rows get equal results, an empty table an
empty one.  Only doc_id, text and lang are read.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import crc_rest, held_out, map_arrow, own_memory, table

DICT_BYTES, SAMPLE_CHARS, PIECE_BYTES, MIN_MARGIN, SCALE = 96 << 10, 2000, 4096, 0.01, 6.0
# Characters that tell nothing of a language.
_BLANK = {c: " " for c in range(128) if not chr(c).isalpha()}


def normalised(text: str) -> bytes:
    """Lower case, letters beyond ASCII as they are, everything else of ASCII one space."""
    return " ".join(text.lower().translate(_BLANK).split()).encode()


def fit_dictionaries(train: DataFrame, dict_bytes: int = DICT_BYTES, sample_chars: int = SAMPLE_CHARS) -> list[tuple[str, bytes]]:
    """Per language (most rows first) about ``dict_bytes`` of sample text."""
    rows = train.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    spare = F.greatest(F.length("text") - sample_chars, F.lit(0))
    part = F.substr("text", (crc_rest("doc_id", 1 << 30, "place") % (spare + 1) + 1).cast("int"), F.lit(sample_chars))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length(part)).alias("chars")).collect()  # a row per language
    mod = 1 << 30
    share = {r["lang"]: min(mod, math.ceil(mod * 1.5 * dict_bytes / max(1, r["chars"]))) for r in sizes}
    if not share:
        return []
    pick = F.coalesce(*[F.when(F.col("lang") == k, F.lit(v)) for k, v in share.items()])
    got: dict[str, list[bytes]] = {k: [] for k in share}
    drawn = rows.withColumn("at_", crc_rest("doc_id", mod, "dict")).where(F.col("at_") < pick)
    for r in drawn.select("lang", "at_", "doc_id", part.alias("part")).sort("at_", "doc_id", "part").toLocalIterator():
        got[r["lang"]].append(normalised(r["part"]))
    order = sorted(sizes, key=lambda r: (-r["n"], r["lang"]))
    return [(r["lang"], b" ".join(got[r["lang"]])[:dict_bytes]) for r in order]


class Classifier:
    def __init__(self, dictionaries: list[tuple[str, bytes]], piece: int = PIECE_BYTES):
        import zstandard as zstd

        # short matches found by a deeper search: words decide, not long copies
        how = zstd.ZstdCompressionParameters(window_log=18, hash_log=16, chain_log=16, search_log=4, min_match=4, strategy=zstd.STRATEGY_GREEDY,
                                             write_content_size=False, write_dict_id=False)
        self.langs, self.piece, self.packers = [k for k, _ in dictionaries], piece, []
        for _, raw in dictionaries:
            d = zstd.ZstdCompressionDict(raw or b" ", dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=how)
            self.packers.append(zstd.ZstdCompressor(compression_params=how, dict_data=d))

    def sizes(self, text: str | None) -> list[int] | None:
        """Compressed bytes by language, None for a text without a letter."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return None
        raw = normalised(text)
        if not raw:
            return None
        pieces = [raw[i:i + self.piece] for i in range(0, len(raw), self.piece)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.packers]

    def __call__(self, text: str | None, min_margin: float) -> tuple[str, float, float, bool]:
        """lang_pred, score, margin, rejected."""
        sizes = self.sizes(text)
        if sizes is None:
            return "und", 0.0, 0.0, True
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1:]
        margin = min(others) / max(1, sizes[best]) - 1 if others else 1.0
        score = 1 / (1 + sum(math.exp(max(-50.0, (sizes[best] - s) / SCALE)) for s in others))
        return self.langs[best], score, margin, margin < min_margin


_READY: dict[int, Classifier] = {}


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], min_margin: float = MIN_MARGIN) -> DataFrame:
    """doc_id, lang (``und`` if rejected), lang_pred, score, margin and rejected per document."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # DICT_BYTES per language

    def run(batch: pa.RecordBatch) -> dict:
        own_memory("language_id", _READY.clear)
        key = hash(tuple(shared.value))
        if key not in _READY:
            _READY.clear()
            _READY[key] = Classifier(shared.value)
        got = [_READY[key](t, min_margin) for t in batch.column(1).to_pylist()]
        lang, score, margin, rejected = zip(*got) if got else ((),) * 4
        return {"doc_id": batch.column(0), "lang_pred": list(lang), "score": list(score), "margin": list(margin), "rejected": list(rejected)}

    out = map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, lang_pred string, score double, margin double, rejected boolean")
    return out.withColumn("lang", F.when(F.col("rejected"), F.lit("und")).otherwise(F.col("lang_pred")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    dictionaries = fit_dictionaries(docs.where(~held_out("doc_id")).select("doc_id", "text", "lang"))
    out = identify(docs, dictionaries)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "margin", "rejected")
