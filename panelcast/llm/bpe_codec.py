"""Operator 3: byte-level BPE encoding and decoding with a pair occurrence index.

``encode`` adds the token ids of a text column, ``decode`` turns ids back into text.  Both run
partition by partition without a shuffle; each task merges the pre-tokens that it has not seen
yet, all together, by the index of ``bytebpe.merge_all``.

Nulls: a null text is encoded as an empty one (no ids, decoded ``""``).  Other columns, nulls in
them included, pass through untouched; one whose name is that of a result gets ``in_`` before its name.  Repeated rows give equal rows; an empty table gives an
empty table.  Whole texts of any length are encoded; the memory needed is that of one text
and of the bounded table of parts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bytebpe
from panelcast.llm.common import map_arrow, table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_texts(texts: list[str | None], path: str, limit: int = bytebpe.PARTS) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers; ``limit`` bounds the parts remembered."""
    bpe = bytebpe.load(path)
    enc = bytebpe.encoder(path, "ids", lambda words: bytebpe.merge_all(words, bpe), limit)
    return [b"".join(p) for p in enc.pieces([t or "" for t in texts], b"", lambda i: i.to_bytes(4, "little"))]


def decode_ids(ids: bytes, path: str) -> str:
    """Text of ids; bytes that are no UTF-8 become U+FFFD, ids outside the vocabulary are left out."""
    tokens = bytebpe.load(path).token_bytes
    size = len(tokens)
    arr = np.frombuffer(ids, "<u4")
    if len(arr) and int(arr.max()) >= size:
        arr = arr[arr < size]
    return b"".join(map(tokens.__getitem__, arr.tolist())).decode("utf-8", "replace")


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus ``out`` binary, the ids as unsigned 32-bit integers."""
    return _mapped(df, text, keep, {out: "binary"}, lambda texts: {out: encode_texts(texts, path)})


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus ``out``, the text of the binary column ``ids`` (null: empty)."""
    return _mapped(df, ids, keep, {out: "string"}, lambda vals: {out: [decode_ids(v or b"", path) for v in vals]})


def round_trip(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, ids: str | None = None,
               limit: int = bytebpe.PARTS) -> DataFrame:
    """Encode and decode in one pass: n_tokens, ids_sha256 and decoded_sha256 beside ``keep``, and the ids
    themselves (binary) if ``ids`` names a column for them."""
    def digests(texts: list[str | None]) -> dict:
        got = encode_texts(texts, path, limit)
        return ({ids: got} if ids else {}) | {
            "n_tokens": [len(i) // 4 for i in got],
            "ids_sha256": [hashlib.sha256(i).hexdigest() for i in got],
            "decoded_sha256": [hashlib.sha256(decode_ids(i, path).encode()).hexdigest() for i in got],
        }

    return _mapped(df, text, keep, ({ids: "binary"} if ids else {}) | {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}, digests)


def _mapped(df: DataFrame, col: str, keep: list[str] | None, new: dict[str, str], fn) -> DataFrame:
    """Run ``fn`` over one column; the kept columns travel as one struct, so names cannot clash on the way.
    At the end a kept column with the name of a new one is called ``in_`` and its name."""
    kept = list(df.columns if keep is None else keep)
    taken, names = {n.lower() for n in new}, []
    for c in sorted(kept, key=lambda c: c.lower() in taken):
        name = c
        while name.lower() in taken:
            name = f"in_{name}"
        taken.add(name.lower())
        names.append((c, name))
    final = dict(names)
    rest = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("_none"))
    narrow = df.select(rest.alias("kept_"), F.col(f"`{col}`").alias("value_"))
    from pyspark.sql.types import StructType

    schema = StructType().add("kept_", narrow.schema["kept_"].dataType)
    for name, kind in new.items():
        schema = schema.add(name, kind if kind != "bigint" else "long")

    def run(batch: pa.RecordBatch) -> dict:
        got = fn(batch.column(1).to_pylist())
        return {"kept_": batch.column(0)} | got

    out = map_arrow(narrow, run, schema)
    return out.select(*[F.col("kept_").getField(c).alias(final[c]) for c in kept], *new)


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document of ``documents``: number and hash of its ids, hash of the decoded text."""
    return round_trip(table(spark, sf_dir, "documents"), vocabulary_path(), keep=["doc_id"], limit=bytebpe.PARTS_ALONE)
