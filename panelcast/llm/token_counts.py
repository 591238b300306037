"""Operator 7: token counts with a whole-token shortcut.

Offline, the vocabulary itself is encoded: a string that is one pre-token and merges into its own
single token is *proven*.  In a text every pre-token that is proven counts 1 without merging;
only the rest is merged.

Nulls: a null text counts as empty (0 bytes, 0 tokens, not over the limit).  Rows are counted one
by one: repeated rows give equal rows, an empty table an empty one, other columns pass through
(``keep`` names some of them); one whose name is that of a result gets ``in_`` before its name.  Whole texts are counted, without truncation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import bytebpe
from panelcast.llm.bpe_codec import _mapped, vocabulary_path
from panelcast.llm.common import table


def prove_whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and encode alone as exactly their own token."""
    bpe = bytebpe.load(path)
    added = set(bpe.special.values())
    words, ids = [], []
    for i, raw in enumerate(bpe.token_bytes):
        try:
            word = raw.decode()
        except UnicodeDecodeError:
            continue
        if raw and i not in added and bytebpe.pretokens(word) == [word]:
            words.append(word)
            ids.append(i.to_bytes(4, "little"))
    return frozenset(w for w, i, got in zip(words, ids, bytebpe.merge_all([w.encode() for w in words], bpe)) if got == i)


def count_texts(texts: list[str | None], path: str, proven: frozenset[bytes], limit: int = bytebpe.PARTS) -> list[int]:
    bpe = bytebpe.load(path)

    def value(words: list[bytes]) -> list[int]:
        rest = [w for w in words if w not in proven]
        merged = dict(zip(rest, (len(i) // 4 for i in bytebpe.merge_all(rest, bpe))))
        return [merged.get(w, 1) for w in words]

    enc = bytebpe.encoder(path, "counts", value, limit)
    return [sum(p) for p in enc.pieces([t or "" for t in texts], 0, lambda i: 1)]


def count_tokens(df: DataFrame, path: str, text: str = "text", limit: int = 512, keep: list[str] | None = None,
                 parts: int = bytebpe.PARTS) -> DataFrame:
    """``keep`` columns plus n_bytes, n_tokens and over_limit (n_tokens > ``limit``).

    The proven strings are broadcast; their number is bounded by the vocabulary."""
    spark = df.sparkSession
    proven = spark.sparkContext.broadcast(frozenset(w.encode() for w in prove_whole_tokens(path)))

    def run(texts: list[str | None]) -> dict:
        counts = count_texts(texts, path, proven.value, parts)
        return {"n_bytes": [len((t or "").encode()) for t in texts], "n_tokens": counts, "over_limit": [n > limit for n in counts]}

    return _mapped(df, text, keep, {"n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}, run)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it exceeds 512 tokens."""
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary_path(), keep=["doc_id"], parts=bytebpe.PARTS_ALONE)
