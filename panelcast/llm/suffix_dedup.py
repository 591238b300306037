"""Operator 6: repeated passages by an enhanced suffix array on content-defined anchors.

1. Every text gives its segments (see ``repeats``): about one per 126 bytes.  Only the hash of the anchor's
   gram, the places and a hash of the segment travel, one row per text and different segment, so a line
   that a text repeats thousands of times costs one row.
2. Grams that occur once are dropped.  Equal segments of the others are folded into one with a count,
   before any text moves, so groups of copies cost one row.
3. The text of one copy of each segment is fetched.  The segments of a gram meet, their suffixes from
   the anchor are sorted into a sparse enhanced suffix array, the common-prefix interval tree is read
   off with a stack, and left extensions are tested; this gives the maximal repeats of at least
   ``span`` bytes with all their occurrences, hence the windows that also start elsewhere.
4. The repeated windows go back to every copy of their segment, and each text drops the bytes they cover.

A gram with more than ``HEAVY`` different segments (a passage in very many documents with other text
around it) is not gathered in one task: its windows are decided by halving.  A range of windows whose
bytes as a whole occur twice is repeated; one whose common core occurs once is not; others are cut
in two, down to single windows.  Both ways give the same exact result.

Nulls and edge cases: a null text is an empty one; texts shorter than ``span`` bytes lose nothing;
rows without doc_id and repeated rows take part like others (a text that occurs twice loses every
byte if it has ``span`` bytes); an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import repeats
from panelcast.llm.common import map_arrow, saved, table
from panelcast.llm.minhash_forest import sorted_groups

SPAN, HEAVY = repeats.SPAN, 20_000
RUNS = "runs array<struct<lo:int,hi:int>>"
_SIGNED = 1 << 63


def signed64(x: int) -> int:
    return x - (1 << 64) if x >= _SIGNED else x


def named(docs: DataFrame, *more: F.Column) -> DataFrame:
    """doc_id, th (hash of the text) and text: the pair names a text, repeated rows share it."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"), *[c.alias("rest") for c in more])


def segments(docs: DataFrame, span: int) -> DataFrame:
    """(doc_id, th, gram, seg, places, off, more): a segment starts at each of ``places``, its anchor ``off``
    bytes later, and it has ``more`` + 1 windows; seg is a hash of its bytes and ``off``."""
    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("row", "gram", "seg", "off", "more", "place", "count")}
        for row, text in enumerate(batch.column(2).to_pylist()):
            raw = text.encode()
            gram, a, lo, hi = repeats.anchors(raw, span)
            if not len(a):
                continue
            off = a - lo
            seg = np.array([xxhash.xxh3_64_intdigest(raw[x:y + span], seed=o) for x, y, o in zip(lo.tolist(), hi.tolist(), off.tolist())], np.uint64).view(np.int64)
            order = np.lexsort((lo, seg, gram))
            gram, seg = gram[order], seg[order]
            first = np.r_[0, np.flatnonzero((np.diff(gram) != 0) | (np.diff(seg) != 0)) + 1]
            out["row"].append(np.full(len(first), row))
            out["place"].append(lo[order])
            out["count"].append(np.diff(np.r_[first, len(order)]))
            for k, v in (("gram", gram), ("seg", seg), ("off", off[order]), ("more", (hi - lo)[order])):
                out[k].append(v[first])
        flat = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}
        rows, ends = pa.array(flat.pop("row")), np.r_[0, np.cumsum(flat.pop("count"))]
        places = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.pop("place"), pa.int64()))
        return {"doc_id": batch.column(0).take(rows), "th": batch.column(1).take(rows), "places": places} | flat

    return map_arrow(docs, run, "doc_id long, th long, gram long, seg long, places array<long>, off int, more int", slice_rows=250)


def segment_texts(kept: DataFrame, docs: DataFrame, span: int) -> DataFrame:
    """(gram, seg, n, off, text) of one copy of every segment in ``kept``."""
    one = kept.groupBy("gram", "seg").agg(F.sum(F.size("places")).alias("n"), F.min(F.struct("doc_id", "th", F.col("places")[0].alias("place"), "off", "more")).alias("at"))
    wanted = one.groupBy("at.doc_id", "at.th").agg(F.collect_list(F.struct("gram", "seg", "n", "at.place", "at.off", "at.more")).alias("wanted"))
    wanted = wanted.withColumnsRenamed({"doc_id": "d_", "th": "t_"})
    both = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["d_"]) & (docs["th"] == wanted["t_"]))

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("gram", "seg", "n", "off", "text")}
        for text, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = text.encode()
            for r in rows:
                for k in ("gram", "seg", "n", "off"):
                    out[k].append(r[k])
                out["text"].append(raw[r["place"]:r["place"] + r["more"] + span])
        return out

    return map_arrow(both.select("text", "wanted"), run, "gram long, seg long, n long, off int, text binary", slice_rows=100)


def by_suffix_array(rows: DataFrame, span: int) -> DataFrame:
    """(gram, seg, runs): the runs (lo, hi) of repeated windows of every segment that has some."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for group in sorted_groups(batches, "gram"):
            unique = {s: (t, o, n) for s, t, o, n in zip(group["seg"], group["text"], group["off"], group["n"])}
            segs = list(unique)
            for s, runs in zip(segs, repeats.repeated_windows([unique[s] for s in segs], span)):
                if runs:
                    held.append((group["gram"][0], s, [{"lo": lo, "hi": hi} for lo, hi in runs]))
            if len(held) > 20_000:
                yield out(held)
                held = []
        if held:
            yield out(held)

    def out(held: list[tuple]) -> pa.RecordBatch:
        g, s, runs = zip(*held)
        kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(s, pa.int64()), pa.array(runs, kind)], names=["gram", "seg", "runs"])

    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, f"gram long, seg long, {RUNS}")


def by_halving(rows: DataFrame, span: int) -> DataFrame:
    """The same for grams with very many segments; nothing of a gram is gathered, only counted."""
    ranges = rows.dropDuplicates(["gram", "seg"]).select("gram", "seg", "n", "off", "text", F.lit(0).alias("lo"), (F.length("text") - span).alias("hi"))
    # ranges are cut at equal distances from the anchor, so that equal content is cut alike
    found, size = None, 1 << (span - 1).bit_length()
    while size:
        def cut(batch: pa.RecordBatch, size: int = size) -> dict:
            out: dict[str, list] = {k: [] for k in ("gram", "seg", "n", "off", "text", "lo", "hi", "full", "core")}
            for r in batch.to_pylist():
                lo = r["lo"]
                while lo <= r["hi"]:
                    hi = min(r["hi"], lo + size - 1 - (lo - r["off"]) % size)
                    key = (lo - r["off"]) // size
                    # the bytes that all windows of the uncut range [key * size, (key + 1) * size) share
                    full, core = r["text"][lo:hi + span], r["text"][r["off"] + (key + 1) * size - 1:max(0, r["off"] + key * size + span)]
                    for k in ("gram", "seg", "n", "off", "text"):
                        out[k].append(r[k])
                    out["lo"].append(lo)
                    out["hi"].append(hi)
                    for k, part, edge in (("full", full, (lo - r["off"], hi - r["off"])), ("core", core, (key, 0))):
                        out[k].append(xxhash.xxh3_128_digest(part + repr((k, r["gram"], *edge)).encode()))
                    lo = hi + 1
            return out

        parts = saved(map_arrow(ranges, cut, "gram long, seg long, n long, off int, text binary, lo int, hi int, full binary, core binary"), "halves")
        whole = parts.groupBy("full").agg(F.sum("n").alias("copies"), F.min("seg").alias("first_"))
        parts = parts.join(whole, "full").withColumn("whole", F.col("copies") > 1)
        some = parts.groupBy("core").agg((F.sum("n") > 1).alias("some"), F.max(~F.col("whole")).alias("open"))
        judged = saved(parts.join(some, "core"), "judged")
        done = judged.where("whole").select("gram", "seg", "lo", "hi")
        found = done if found is None else found.union(done)
        # one copy of a decided range stays as a witness for undecided ones with the same core
        ranges = judged.where("open and some and (not whole or seg = first_)" if size > 1 else "false")
        ranges = ranges.withColumn("n", F.when(F.col("whole"), F.col("copies")).otherwise(F.col("n"))).select("gram", "seg", "n", "off", "text", "lo", "hi")
        size //= 2
        if ranges.isEmpty():
            break
    # the ranges of one segment are bounded by its length
    return found.groupBy("gram", "seg").agg(F.collect_list(F.struct(F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi"))).alias("runs"))


def repeated_spans(docs: DataFrame, span: int = SPAN, heavy: int = HEAVY) -> DataFrame:
    """(doc_id, th, spans): byte ranges [lo, hi) of each text that has repeated windows, unsorted."""
    rows = saved(segments(docs, span), "segments")
    # copies of a segment are counted first, so a gram in very many copies of one text is not one task's work
    often = rows.groupBy("gram", "seg").agg(F.sum(F.size("places")).alias("c")).groupBy("gram").agg(F.sum("c").alias("copies")).where("copies > 1").select("gram")
    kept = saved(rows.join(often, "gram"), "kept")
    texts = saved(segment_texts(kept, docs, span), "texts")
    sizes = texts.groupBy("gram").agg(F.count("*").alias("m")).where(F.col("m") > heavy).select("gram")
    large = saved(sizes, "heavy")
    if large.isEmpty():
        runs = by_suffix_array(texts, span)
    else:
        runs = by_suffix_array(texts.join(large, "gram", "left_anti"), span).union(by_halving(texts.join(large, "gram"), span))
    runs = saved(runs, "runs").withColumnsRenamed({"gram": "g_", "seg": "s_"})
    back = kept.join(runs, (F.col("gram") == F.col("g_")) & (F.col("seg") == F.col("s_")))
    # one row per text and segment, whatever the number of its places and runs
    placed = F.flatten(F.transform("places", lambda p: F.transform("runs", lambda r: F.struct((p + r["lo"]).alias("lo"), (p + r["hi"] + span).alias("hi")))))
    return back.select("doc_id", "th", placed.alias("s")).groupBy("doc_id", "th").agg(F.flatten(F.collect_list("s")).alias("spans"))


def cover(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Disjoint byte ranges [lo, hi), in order."""
    return [(lo, hi + 1) for lo, hi in repeats.joined([(s["lo"], s["hi"] - 1) for s in spans or []])]


def with_spans(docs: DataFrame, span: int = SPAN, heavy: int = HEAVY, keep: list[str] | None = None) -> DataFrame:
    """doc_id, th, text and spans (null: none) for every row, and in a struct ``rest`` the columns ``keep`` and whether the text was null."""
    spans = repeated_spans(named(docs), span, heavy).withColumnsRenamed({"doc_id": "d_", "th": "t_"})
    rest = F.struct(F.struct(F.lit(0).alias("_none"), *[F.col(f"`{c}`") for c in keep]).alias("cols"), F.col("text").isNull().alias("null")) if keep is not None else F.lit(None).cast("int")
    rows = named(docs, rest)
    return rows.join(spans, rows["doc_id"].eqNullSafe(F.col("d_")) & (F.col("th") == F.col("t_")), "left").select("doc_id", "th", "text", "spans", "rest")


def kept_bytes(raw: bytes, gone: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in gone for x in s), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def without_spans(text: str, spans: list[dict] | None) -> str:
    """The text without its repeated bytes; a character stays unless all of its bytes are covered."""
    raw, gone = text.encode(), []
    for lo, hi in cover(spans):
        while lo < hi and raw[lo] & 0xC0 == 0x80:
            lo += 1
        while lo < hi < len(raw) and raw[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo < hi:
            gone.append((lo, hi))
    return kept_bytes(raw, gone).decode()


def deduplicated(docs: DataFrame, span: int = SPAN, heavy: int = HEAVY) -> DataFrame:
    """The rows of ``docs`` (all columns) with the repeated passages cut out of ``text``."""
    rows = with_spans(docs, span, heavy, [c for c in docs.columns if c != "text"]).select("rest", "text", "spans")

    def run(batch: pa.RecordBatch) -> dict:
        texts = [without_spans(t, s) if s else t for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        return {"rest": batch.column(0), "new_": texts}

    from pyspark.sql.types import StringType

    out = map_arrow(rows, run, rows.select("rest").schema.add("new_", StringType()), slice_rows=500)
    text = F.when(~F.col("rest.null"), F.col("new_"))  # a null text stays null
    return out.select(*[(text if c == "text" else F.col("rest.cols").getField(c)).alias(c) for c in docs.columns])


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes, removed runs and the hash of what remains, per document."""
    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            raw, gone = text.encode(), cover(spans)
            left = kept_bytes(raw, gone)
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(len(raw) - len(left))
            out["n_spans"].append(len(gone))
            out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
        return {"doc_id": batch.column(0)} | out

    return map_arrow(with_spans(table(spark, sf_dir, "documents")), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
