"""Operator 2: quality rules with adaptive thresholds per language and source.

Every statistic gets its fences from the data: a KLL quantile sketch per (lang, source) gives the
quartiles, and a document fails when a statistic lies more than ``reach`` quartile distances (of a
least width, so that constant statistics do not reject rounding noise) beyond them.  The sketches are
mergeable: one pass aggregates them per (lang, source) with partial aggregation, and the sketches of
small groups are widened by merging into those of their language and of the whole table, without
reading a document again.  A second step joins the fences to the documents and filters.

Base rules come first: fewer than 20 words, or more than 30 % of the words in repeated 8-word windows.
Documents that fail them neither enter a sketch nor are kept.

Against a hot group (a third of all rows may be copies of one text) every text counts once in a sketch
however often it is copied.  A group with ``min_group`` texts is judged by its own quartiles alone, so a
clean minority language or source may differ from the rest of the table as far as it does.

Nulls and edge cases: null lang and null source are groups of their own; a null text has no words and
fails the base rules; repeated rows are judged alike; an empty table gives an empty result.  Clashing
names of extra columns don't matter, only doc_id, text, lang and source are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import saved, table
from panelcast.llm.doc_stats import with_stats

#: statistic -> (side, least quartile distance): the scale below which differences mean nothing
FENCED = {
    "symbol_ratio": ("high", 0.01), "upper_ratio": ("high", 0.03), "mark_ratio": ("high", 0.05), "dup_line_ratio": ("high", 0.1),
    "top_ratio": ("high", 0.04), "mean_word": ("high", 0.4), "long_ratio": ("high", 0.05), "unique_ratio": ("low", 0.04),
}
MIN_WORDS, MAX_REPEAT_PCT = 20, 30
REACH, MIN_GROUP, SKETCH_K = 4.0, 50, 400
_RANKS = {"lo": 0.25, "hi": 0.75}


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def sketch_groups(stats: DataFrame) -> DataFrame:
    """(lang, source) -> a sketch per statistic and the number of distinct texts."""
    once = stats.groupBy("lang", "source", "text_hash").agg(*[F.first(s).alias(s) for s in FENCED])
    return once.groupBy("lang", "source").agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(s, F.lit(SKETCH_K)).alias(s) for s in FENCED])


def fences(groups: DataFrame, reach: float = REACH, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source) -> one fence per statistic, from the group's own sketch if it has ``min_group``
    texts, else from its language's, else from the whole table's."""
    def merged(df: DataFrame, keys: list[str], tag: str) -> DataFrame:
        got = df.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(s, F.lit(SKETCH_K)).alias(s) for s in FENCED])
        return quartiles(got.where("n > 0"), keys, tag)

    def quartiles(df: DataFrame, keys: list[str], tag: str) -> DataFrame:
        cols = [F.kll_sketch_get_quantile_double(s, F.lit(r)).alias(f"{tag}_{s}_{q}") for s in FENCED for q, r in _RANKS.items()]
        return df.select(*[F.col(k).alias(f"{tag}_{k}") for k in keys], F.col("n").alias(f"{tag}_n"), *cols)

    own, lang = quartiles(groups, ["lang", "source"], "g"), merged(groups, ["lang"], "l")
    row = merged(groups, [], "w").first()  # one row, whatever the table's size; none without texts
    whole = row.asDict() if row else {f"w_{s}_{q}": None for s in FENCED for q in _RANKS}
    df = own.join(lang, own["g_lang"].eqNullSafe(lang["l_lang"]), "left")

    def fence(s: str, side: str, least: float) -> F.Column:
        def at(tag: str) -> F.Column:
            lo, hi = (F.lit(whole[f"w_{s}_{q}"]).cast("double") if tag == "w" else F.col(f"{tag}_{s}_{q}") for q in ("lo", "hi"))
            width = reach * F.greatest(hi - lo, F.lit(least))
            return hi + width if side == "high" else lo - width

        return F.when(F.col("g_n") >= min_group, at("g")).when(F.col("l_n") >= min_group, at("l")).otherwise(at("w")).alias(f"fence_{s}")

    return df.select(F.col("g_lang").alias("f_lang"), F.col("g_source").alias("f_source"), F.col("g_n").alias("group_texts"), *[fence(s, *how) for s, how in FENCED.items()])


def judge(docs: DataFrame, reach: float = REACH, min_group: int = MIN_GROUP) -> DataFrame:
    """Statistics, fences, base_failed, the list of failed rules and kept, per document."""
    hashed = docs.select("doc_id", "lang", "source", "text", F.xxhash64("text").alias("text_hash"))
    stats = saved(with_stats(hashed, keep=("doc_id", "lang", "source", "text_hash")).withColumn("base_failed", base_failed()), "stats")
    limits = saved(fences(sketch_groups(stats.where(~F.col("base_failed"))), reach, min_group), "fences")
    df = stats.join(limits, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    fails = [F.when((F.col(s) > F.col(f"fence_{s}")) if side == "high" else (F.col(s) < F.col(f"fence_{s}")), F.lit(s)) for s, (side, _) in FENCED.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*fails))).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics, base verdict and the verdict of the adaptive rules, per document."""
    out = judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")
