"""Operator 1: token ids as Arrow files of equal-length sequences.

Layout of a dataset: one shard per range of ids, each shard two Arrow IPC files.
``ids-NNNNN.arrow`` holds record batches of fixed-size lists: ``ids`` (``seq_len`` token ids, the
smallest unsigned type that holds the vocabulary) and ``mask`` (``seq_len`` bits, packed into
``seq_len / 8`` bytes; 1 marks a real token).  All lists of a shard are full but the last one, whose
tail is 0 with mask 0.  Every batch but the last holds the same number of sequences, so sequence
``i`` is found by arithmetic and read, memory-mapped, without copying.  ``docs-NNNNN.arrow`` holds
``doc_id``, ``start`` (in the shard) and ``n_tokens`` per document.  ``manifest`` is a Parquet table
with a row per shard.  The documents stand in ascending ``doc_id`` order over all shards.

Nulls and ties: a null text is an empty one (its only token is the end id); rows without doc_id come
first; rows of one doc_id are ordered by a hash of their text and each keeps its own entry, repeated
rows too.  An empty table gives a dataset without shards.  Very long texts span many sequences; a task
holds one batch of sequences and one text at a time.  Other columns are not read.

Files are written under a temporary name and moved when whole, so a task that is repeated after the
loss of its executor leaves the same file.  The folder must be one that all executors share.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import own_memory, scratch, table

SEQ_LEN = 1024
BATCH_SEQS = 64
SHARD_BYTES = 16 << 20
END_ID = 2


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: The rule by which ``word_bpe_49k.json`` makes pre-tokens, and what it does to a text before.
SPLIT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMAL_FORM = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
#: A part of Latin letters with or without other signs behind them, or anything else.  The apostrophe is not
#: among the signs, as it binds letters; a mark that could change the letter before it is not ASCII.
LETTERS_AND_SIGNS = re.compile(r"^([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)$|^.*$", re.MULTILINE)


class IdMemory:
    """The ids of many strings in one array: string -> its place, place -> (start, number of ids)."""

    def __init__(self, dtype: np.dtype):
        self.place: dict[str, int] = {}
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.used = np.zeros(4096, dtype), 0

    def add(self, strings: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        """Strings not seen before with their ids, one string's after the other's."""
        first = len(self.place)
        last, used = first + len(strings), self.used + len(flat)
        self.place.update(zip(strings, range(first, last)))
        self.start, self.size, self.pool = _room(self.start, last), _room(self.size, last), _room(self.pool, used)
        self.start[first:last] = self.used + np.cumsum(sizes) - sizes
        self.size[first:last] = sizes
        self.pool[self.used:used] = flat
        self.used = used

    def places(self, strings: Sequence[str]) -> np.ndarray:
        """The place of every string, -1 for one not seen before."""
        return np.fromiter(map(self.place.get, strings, itertools.repeat(-1)), np.int64, len(strings))

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings at ``places``, and how many each has."""
        start, size = self.start[places], self.size[places]
        ends = np.cumsum(size)
        return self.pool[np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)], size


class ChunkEncoder:
    """Ids of texts by the tokenizers library, with a memory of parts already encoded.

    Only for tokenizers whose pre-tokens never hold white space: a text is then the sequence of
    its parts between ASCII white space, each encoded alone.  The memory is bounded by ``limit``
    parts; beyond that it starts anew, which costs time only.

    Under ``SPLIT_RULE`` and ``NORMAL_FORM`` a part of Latin letters with signs behind them is two pre-tokens,
    whose normal form is their lower case.  Such parts share the ids of their pre-tokens, and the library's
    model takes these without looking for a normal form and for cuts again."""

    def __init__(self, path: str, limit: int = 1_000_000):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tok, self.limit = Tokenizer.from_file(path), limit
        self.tok.no_truncation()
        self.tok.no_padding()
        probe = self.tok.encode(" a \n b\tc \x0b\x0c\r ", add_special_tokens=False).ids
        if probe != [i for c in "abc" for i in self.tok.encode(c, add_special_tokens=False).ids]:
            raise ValueError(f"{path}: its tokens hold white space, parts can't be encoded alone")
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        rules = json.loads(self.tok.to_str())
        split, *bytes_ = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.model = None
        if ((rules["normalizer"] or {}).get("normalizers") == NORMAL_FORM and split.get("pattern") == {"Regex": SPLIT_RULE}
                and (split["behavior"], split["invert"]) == ("Removed", True)
                and [(b["type"], b["add_prefix_space"], b["use_regex"]) for b in bytes_] == [("ByteLevel", False, False)]
                and all(t["special"] and not t["single_word"] and not t["content"].isalpha() for t in rules["added_tokens"])):
            self.model = Tokenizer.from_str(self.tok.to_str())
            self.model.normalizer = None
            self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.forget()

    def forget(self) -> None:
        """Start anew."""
        self.known, self.pieces = IdMemory(self.dtype), IdMemory(self.dtype)

    def library(self, tok, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``strings``, one string's after the other's, and how many each has."""
        found = tok.encode_batch_fast(strings, add_special_tokens=False)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(e.ids for e in found), self.dtype, int(sizes.sum())), sizes

    def learn(self, parts: list[str]) -> None:
        if self.model:
            heads, tails = zip(*LETTERS_AND_SIGNS.findall("\n".join(parts)))
            both = [w for w, head in zip(parts, heads) if head]
            pieces = [""] * (2 * len(both))
            pieces[::2] = "\n".join(filter(None, heads)).lower().split("\n") if both else []
            pieces[1::2] = itertools.compress(tails, heads)
            new = [p for p in dict.fromkeys(pieces) if p not in self.pieces.place]
            self.pieces.add(new, *self.library(self.model, new))
            flat, sizes = self.pieces.ids(self.pieces.places(pieces))
            self.known.add(both, flat, sizes[::2] + sizes[1::2])
            parts = [w for w, head in zip(parts, heads) if not head]
        self.known.add(parts, *self.library(self.tok, parts))

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text.  Texts are cut into parts and the parts numbered by Arrow; Python sees every
        different part once, and numpy gathers the ids."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        parts = split.flatten().dictionary_encode()
        words = parts.dictionary.to_numpy(zero_copy_only=False)
        places = self.known.places(words)
        new = places < 0
        if len(self.known.place) + np.count_nonzero(new) > self.limit:
            self.forget()
            new[:] = True
        if new.any():
            self.learn(words[new].tolist())
            places[new] = self.known.places(words[new])
        flat, size = self.known.ids(places[parts.indices.to_numpy()])
        ends = np.cumsum(size)
        cuts = split.offsets.to_numpy() - split.offsets[0].as_py()
        return np.split(flat, np.r_[0, ends][cuts[1:-1]]) if len(cuts) > 1 else []


def _room(x: np.ndarray, n: int) -> np.ndarray:
    """``x`` with space for n values at least."""
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    own_memory("token_files", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


class ShardWriter:
    """Writes one shard; documents are appended in order, memory is one batch of sequences."""

    def __init__(self, folder: str, shard: int, dtype: np.dtype, seq_len: int, batch_seqs: int):
        self.fs, self.root = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
        self.fs.create_dir(self.root, recursive=True)
        self.names = {k: f"{k}-{shard:05d}.arrow" for k in ("ids", "docs")}
        tag = uuid.uuid4().hex
        self.temp = {k: f"{self.root}/.{n}.{tag}" for k, n in self.names.items()}
        self.seq_len, self.room = seq_len, seq_len * batch_seqs
        self.ids_schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), seq_len)), ("mask", pa.list_(pa.uint8(), seq_len // 8))])
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out = {k: self.fs.open_output_stream(p) for k, p in self.temp.items()}
        self.ids = pa.ipc.new_file(self.out["ids"], self.ids_schema)
        self.docs = pa.ipc.new_file(self.out["docs"], self.docs_schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = self.n_docs = 0
        self.index: list[tuple] = []
        self.dtype = dtype

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.index.append((doc_id, self.n_tokens, len(ids)))
        self.n_tokens += len(ids)
        self.n_docs += 1
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.room:
            flat = np.concatenate(self.held)
            whole = len(flat) // self.room * self.room
            for at in range(0, whole, self.room):
                self._batch(flat[at:at + self.room])
            self.held, self.n_held = [flat[whole:].copy()], len(flat) - whole
        if len(self.index) >= 50_000:
            self._index()

    def _batch(self, flat: np.ndarray) -> None:
        n = -(-len(flat) // self.seq_len)
        ids = np.zeros(n * self.seq_len, self.dtype)
        ids[:len(flat)] = flat
        mask = np.zeros(n * self.seq_len, np.uint8)
        mask[:len(flat)] = 1
        cols = [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.seq_len), pa.FixedSizeListArray.from_arrays(pa.array(np.packbits(mask)), self.seq_len // 8)]
        self.ids.write_batch(pa.record_batch(cols, schema=self.ids_schema))

    def _index(self) -> None:
        cols = list(zip(*self.index))
        self.docs.write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in cols], schema=self.docs_schema))
        self.index = []

    def close(self) -> tuple[str, str, int, int]:
        if self.n_held:
            self._batch(np.concatenate(self.held))
        if self.index:
            self._index()
        for k, writer in (("ids", self.ids), ("docs", self.docs)):
            writer.close()
            self.out[k].close()
            self.fs.move(self.temp[k], f"{self.root}/{self.names[k]}")
        return self.names["ids"], self.names["docs"], self.n_tokens, self.n_docs


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = END_ID, seq_len: int = SEQ_LEN,
                      batch_seqs: int = BATCH_SEQS, shard_bytes: int = SHARD_BYTES, text: str = "text") -> str:
    """Encode whole texts and write the dataset; returns its folder.

    The number of shards follows the bytes of text.  One shuffle (ranges of doc_id); encoding
    happens behind it, so the sample for the ranges does not encode anything."""
    if seq_len % 8:
        raise ValueError("seq_len must be a multiple of 8")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    tie = F.xxhash64("text")
    dealt = rows.withColumn("tie", tie).repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, writer, encode = TaskContext.get().partitionId(), None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                if not part.num_rows:
                    continue
                encode = encode or _encoder(tokenizer)
                writer = writer or ShardWriter(folder, shard, encode.dtype, seq_len, batch_seqs)
                end = np.array([] if end_id is None else [end_id], encode.dtype)
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text"))):
                    writer.add(doc_id, np.concatenate([ids, end]))
        if writer:
            ids, index, n_tokens, n_docs = writer.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "ids_file": [ids], "docs_file": [index], "n_tokens": [n_tokens], "n_docs": [n_docs]})

    dealt.mapInArrow(write, "shard long, ids_file string, docs_file string, n_tokens long, n_docs long").write.parquet(f"{folder}/manifest")
    return folder


def _open(folder: str, name: str) -> pa.ipc.RecordBatchFileReader:
    fs, root = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
    if isinstance(fs, pafs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(f"{root}/{name}"))
    return pa.ipc.open_file(fs.open_input_file(f"{root}/{name}"))


def read_sequences(folder: str, ids_file: str, which: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Random access: the ids and masks (0/1) of sequences of one shard, by their numbers."""
    with _open(folder, ids_file) as f:
        per = f.get_batch(0).num_rows
        ids, masks = [], []
        for i in which:
            batch = f.get_batch(i // per)
            ids.append(sequence(batch.column(0), i % per))
            masks.append(np.unpackbits(sequence(batch.column(1), i % per)))
        return np.stack(ids), np.stack(masks)


def sequence(lists: pa.FixedSizeListArray, i: int) -> np.ndarray:
    """View of one list, without copying."""
    size = lists.type.list_size
    return lists.values.to_numpy(zero_copy_only=True)[(lists.offset + i) * size:(lists.offset + i + 1) * size]


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Read the files back: doc_id, shard, start (ids before it in the dataset), n_tokens, ids_crc32."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    # a row per shard: the running sum is over a table of a few dozen bytes for each SHARD_BYTES of text
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("offset", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _open(folder, row["ids_file"]) as ids, _open(folder, row["docs_file"]) as docs:
                    flat, at, k, real = np.zeros(0, np.uint16), 0, 0, 0
                    for b in range(docs.num_record_batches):
                        index = docs.get_batch(b)
                        sums = []
                        for n in index.column("n_tokens").to_pylist():
                            crc = 0
                            while n:
                                if at == real:
                                    got = ids.get_batch(k)
                                    k += 1
                                    flat = got.column(0).values.to_numpy(zero_copy_only=True)
                                    real = int(np.unpackbits(got.column(1).values.to_numpy(zero_copy_only=True)).sum())
                                    at = 0
                                take = min(n, real - at)
                                crc = zlib.crc32(flat[at:at + take].astype("<u4").tobytes(), crc)
                                at += take
                                n -= take
                            sums.append(crc)
                        start = np.asarray(index.column("start")) + row["offset"]
                        yield pa.RecordBatch.from_arrays([index.column("doc_id"), pa.array([row["shard"]] * len(sums), pa.int64()), pa.array(start), index.column("n_tokens"), pa.array(sums, pa.int64())], names=["doc_id", "shard", "start", "n_tokens", "ids_crc32"])

    return shards.repartition("shard").mapInArrow(read, "doc_id long, shard long, start long, n_tokens long, ids_crc32 long")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``documents`` as token files in the shared folder and read every document back."""
    folder = write_token_files(table(spark, sf_dir, "documents"), scratch(spark, "token-files"), vocabulary_path())
    return read_documents(spark, folder)
