"""Conversation structure repair: damaged turn lists become well-formed ones at the least cost.

Steps, all keyed so that no conversation has to fit one task:

1. Every row becomes a narrow one (conversation, turn, role initial, digest of role and text, flags).
   They are sorted by range of (conversation, turn, ...), so a long conversation spreads over tasks,
   numbered, and written.  Rows that repeat an earlier (role, text) are found by the first number of
   each digest, a partial aggregation and a join on the number.
2. ``PIECE`` neighbouring rows of a conversation become one string of symbols.
3. Re-Pair on all distinct pieces: a Spark pass counts pairs, the most frequent ones become rules, up to
   ``RULES``.  The rules' matrices (``repair_grammar``) are made once and go to every task.
4. Every conversation's audit is a product of few matrices.
5. The audit travels ahead of its conversation's rows in one shuffle, sorted; a task streams the rows
   behind it through SHA-256 and holds no text but the current one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import map_arrow, saved, ship, table
from panelcast.llm.repair_grammar import FAULTS, FIRST, INITIALS, INSERT, REROLE, ROLE, RULES_MAX, Grammar, batch_of, meaning, pair_counts, walk

PIECE = 1024
#: Bounds the table of rules that goes to every task.  Pairs beyond it cost a product each; nothing is left out.
RULES = 2048
#: Passes over the distinct pieces that look for rules, and rules taken from one pass.
PASSES, PASS_RULES = 8, 256
SPACE = " \t\n\x0b\x0c\r"

FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The table (conv_id, turn, role, text) with one fault per crc32(conv_id:turn) % 20: 0 drops the row, 1
    empties its text, 2 takes out ``.``, ``!`` and ``?``, 3 gives it twice, 4 sets its role to user.
    Null ids count as one space in the key, null roles and texts become one space.  Rows of fault 0 stay as
    rows with ``copies`` 0, so that no conversation is lost."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word(conv), F.lit(":"), word(turn)).cast("binary")) % 20
    t = word(text)
    return df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(word(role)).alias("role"),
                     F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(t, ".!?", "")).otherwise(t).alias("text"),
                     F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat_ws("\x00", F.length("role").cast("string"), "role", "text").cast("binary"), 256))


def _code() -> Column:
    """Symbol of a row, the duplicate fault aside."""
    body = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    at = F.coalesce(*[F.when(initial == c, F.lit(i)) for i, c in enumerate(INITIALS[:3])], F.lit(3))
    fault = F.when(body == "", FAULTS.index("blank")).when(~F.substring(body, -1, 1).isin(".", "!", "?"), FAULTS.index("truncated")).otherwise(0)
    return (at * 4 + fault).cast("int")


def narrow_rows(rows: DataFrame) -> DataFrame:
    """One row per undamaged or damaged turn (copies apart): conv_id, turn, role, digest, copies, code."""
    return rows.select("conv_id", "turn", "role", _digest().alias("digest"), "copies", _code().alias("code"))


def sequences(rows: DataFrame) -> DataFrame:
    """Pieces of every conversation in order: conv_id, piece, symbols, turns (first, last, distinct), texts apart."""
    n = narrow_rows(rows)
    order = ["conv_id", "turn", "role", "digest"]
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    put = saved(n.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "turns")
    # the first row of every (conversation, role, text); a conversation of one repeated text collapses before the shuffle
    first = put.where(F.col("copies") > 0).groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    marked = put.drop("role", "digest").join(first, "at", "left")
    blank, repeat = FAULTS.index("blank"), FAULTS.index("duplicate")
    again = F.col("code") - F.col("code") % 4 + F.when(F.col("code") % 4 == blank, blank).otherwise(repeat)
    char = lambda c: F.char((c + FIRST).cast("bigint"))
    signs = F.when(F.col("copies") == 0, F.lit("")).otherwise(F.concat(char(F.when(F.col("first"), F.col("code")).otherwise(again)),
                                                                      F.when(F.col("copies") == 2, char(again)).otherwise(F.lit(""))))
    listed = F.sort_array(F.collect_list(F.struct("at", signs.alias("signs"))))          # at most PIECE rows
    turn = F.when(F.col("copies") > 0, F.col("turn"))
    return (marked.withColumn("piece", F.floor(F.col("at") / PIECE)).groupBy("conv_id", "piece")
            .agg(F.array_join(F.transform(listed, lambda s: s["signs"]), "").alias("symbols"), F.min(turn).alias("lo"), F.max(turn).alias("hi"),
                 F.size(F.collect_set(turn)).alias("turns")))


def learn(pieces: DataFrame, rules: int = RULES, passes: int = PASSES) -> list[str]:
    """Re-Pair over all distinct pieces, weighted by how often they occur: the rules in order.

    Each pass applies the rules so far, counts pairs in the tasks, and turns the most frequent pairs that
    don't overlap into rules.  Only counts of pairs reach the driver, ``PASS_RULES`` a pass."""
    rules = min(rules, RULES_MAX)
    distinct = saved(pieces.where(F.length("symbols") > 1).groupBy("symbols").agg(F.count(F.lit(1)).alias("times")), "repair-pieces")
    found: list[str] = []
    for _ in range(passes):
        counted = (map_pairs(distinct, list(found)).groupBy("pair").agg(F.sum("times").alias("times")).where(F.col("times") > 1)
                   .orderBy(F.desc("times"), "pair").limit(PASS_RULES).collect())
        chosen = batch_of([(r["pair"], r["times"]) for r in counted])[:rules - len(found)]
        if not chosen:
            break
        found += chosen
    return found


def map_pairs(distinct: DataFrame, found: list[str]) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(found)
        for batch in batches:
            pairs: dict[str, int] = {}
            for text, times in zip(batch.column("symbols").to_pylist(), batch.column("times").to_pylist()):
                pair_counts(grammar.packed(text), times, pairs)
            yield pa.RecordBatch.from_arrays([pa.array(list(pairs), pa.string()), pa.array(list(pairs.values()), pa.int64())], names=["pair", "times"])

    return distinct.mapInArrow(count, "pair string, times long")


def _figures(grammar: Grammar, memory: dict, pieces: list[dict]) -> dict:
    """Counts, cost and audit of one conversation from its pieces (in order)."""
    key = tuple(p["symbols"] for p in pieces if p["symbols"])
    if key not in memory:
        if len(memory) >= 50_000:
            memory.clear()
        faults, illegal, last = dict.fromkeys(FAULTS, 0), 0, ""
        for text in key:
            for sym in text:
                initial, fault = meaning(sym)
                faults[fault] += 1
                illegal += bool(last) and last + initial not in ("su", "ua", "au")
                last = initial
        cost, audit = grammar.repair(list(key))
        memory[key] = {"blank": faults["blank"], "duplicate": faults["duplicate"], "truncated": faults["truncated"], "illegal": illegal, "cost": cost, "audit": audit}
    lo = hi = None
    turns = 0
    for p in pieces:                       # rows are in order of turn, so pieces share a turn at their edges at most
        if p["lo"] is not None:
            turns += p["turns"] - (hi == p["lo"])
            lo, hi = p["lo"] if lo is None else lo, p["hi"]
    return memory[key] | {"gaps": hi - lo + 1 - turns if lo is not None else 0}


def audits(pieces: DataFrame, rules: list[str]) -> DataFrame:
    """Counts, cost and audit per conversation."""
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("piece", "symbols", "lo", "hi", "turns"))).alias("pieces"))
    names = [f.split()[0] for f in FOUND.split(", ")]
    memory: dict = {}

    def run(batch: pa.RecordBatch) -> dict:
        if "grammar" not in memory:
            memory["grammar"], memory["known"] = Grammar(rules), {}
        rows = [_figures(memory["grammar"], memory["known"], p) for p in batch.column("pieces").to_pylist()]
        return {"conv_id": batch.column("conv_id")} | {n: [r[n] for r in rows] for n in names}

    return map_arrow(whole, run, f"conv_id {pieces.schema['conv_id'].dataType.simpleString()}, {FOUND}")


class _Digest:
    """SHA-256 of a repaired conversation, fed row by row."""

    def __init__(self, audit: str):
        self.sha, self.started, self.steps = hashlib.sha256(), False, walk(audit)
        self.now = next(self.steps, None)

    def _line(self, role: str, text: str) -> None:
        self.sha.update(("\n" if self.started else "").encode() + f"{role}:{text}".encode())
        self.started = True

    def _next(self, initial: str | None) -> None:
        try:
            self.now = self.steps.send(initial)
        except StopIteration:
            self.now = None

    def inserts(self) -> None:
        while self.now and self.now[0] == "I":
            self._line(ROLE[self.now[1]], "")
            self._next(None)

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit, wanted = self.now
        if edit == "K":
            self._line(role, text)
        elif edit == "R":
            self._line(ROLE[wanted], text)
        self._next(role[:1])

    def done(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


def _hashes(names: list[str]):
    """The streamed task: every conversation's audit row, then its turns in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest = None, None
        for batch in batches:
            cols = {c: batch.column(c) for c in batch.schema.names}
            lead = cols["lead"].to_pylist()
            role, text, copies = cols["role"].to_pylist(), cols["text"].to_pylist(), cols["copies"].to_pylist()
            out: list[dict] = []
            for i, first in enumerate(lead):
                if first:
                    if head is not None:
                        out.append(head | {"repaired_sha256": digest.done()})
                    head = {n: cols[n][i].as_py() for n in names}
                    digest = _Digest(head["audit"])
                else:
                    for _ in range(copies[i]):
                        digest.row(role[i], text[i])
            if out:
                yield _rows(out, names, batch.schema)
            kept = batch.schema
        if head is not None:
            yield _rows([head | {"repaired_sha256": digest.done()}], names, kept)

    return run


def _rows(rows: list[dict], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    cols = [pa.array([r[n] for r in rows], schema.field(n).type) for n in names] + [pa.array([r["repaired_sha256"] for r in rows], pa.string())]
    return pa.RecordBatch.from_arrays(cols, names=[*names, "repaired_sha256"])


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, copies): gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    Rows count in order of turn, nulls first; equal turns go by role and then by SHA-256 of role and text.
    A null conv_id is a conversation of its own.  Faults: blank (white space only), duplicate (role and text
    seen earlier), truncated (last other character is not ``.``, ``!`` or ``?``).  A conversation without rows
    (all copies 0) gives zeros, an empty audit and the hash of the empty string; an empty table gives an
    empty result.  A role's initial is its first character; roles beyond s, u and a can only be changed or
    deleted.  Repeated rows are duplicates.  Texts of any length pass through one at a time; the audit, one
    character a row or insertion, is the one thing of a conversation that a task holds whole."""
    ship(rows.sparkSession)
    pieces = saved(sequences(rows), "pieces")
    found = audits(pieces, learn(pieces))
    names = ["conv_id", *[f.split()[0] for f in FOUND.split(", ")]]
    none = [F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in FOUND.split(", ")]
    turns = rows.where(F.col("copies") > 0).select("conv_id", F.lit(False).alias("lead"), "turn", "role", _digest().alias("digest"), "text", "copies", *none)
    heads = found.select("conv_id", F.lit(True).alias("lead"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
                         F.lit(None).cast("binary").alias("digest"), F.lit("").alias("text"), F.lit(0).alias("copies"), *names[1:])
    met = heads.unionByName(turns).repartition("conv_id").sortWithinPartitions("conv_id", F.desc("lead"), "turn", "role", "digest")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return met.drop("digest", "turn").mapInArrow(_hashes(names), f"conv_id {kind}, {FOUND}, repaired_sha256 string")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation of the damaged table."""
    return repair(damaged(table(spark, sf_dir, "conversations")))
