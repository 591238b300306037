"""Temporal ordering and validation splits.

A split is data, not a list of positions: rows get ``(fold, role)`` columns, one output
row per fold a row takes part in.  A labelled row trains in at most ``k`` folds and
validates in at most one, so the exploded table is bounded by ``k+1`` times the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from panelcast.functions.timefeat import clock_parts, sort_key
from panelcast.operators.ordinal import global_ordinal
from panelcast.schema import PanelSpec

N_SPLITS = 5


def sort_keyed(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """``df`` with its temporal sort key."""
    if "sort_key" in df.columns:
        return df
    h, m = clock_parts(spec.clock)
    return df.withColumn("sort_key", sort_key(F.col(spec.day), h, m))


def temporal_positions(df: DataFrame, spec: PanelSpec = PanelSpec(), name: str = "pos") -> DataFrame:
    """Stable 0-based position in (day, hour, minute) order, ties broken by row id."""
    return global_ordinal(sort_keyed(df, spec), ["sort_key", spec.row_id], name=name)


def start_tests(positioned: DataFrame, order: list[str], n: int, k: int = N_SPLITS, pos: str = "pos") -> list[Column] | None:
    """V1: for each validation block, whether a row comes in ``order`` (NULLs first) no sooner than the row that the block starts
    at; None where a start shares its place with the row before, so that only positions tell the two apart."""
    at = [start for _, start, _ in fold_bounds(n, k)]
    found = {r[pos]: r for r in positioned.where(F.col(pos).isin([p for a in at for p in (a - 1, a)])).collect()}     # 2 k rows
    if any(a - 1 in found and [found[a - 1][c] for c in order] == [found[a][c] for c in order] for a in at):
        return None
    types = dict(positioned.dtypes)

    def no_sooner(start: Row) -> Column:
        out = F.lit(True)
        for c in reversed(order):
            x, v = F.col(c), F.lit(start[c]).cast(types[c])
            later = x.isNotNull() if start[c] is None else F.coalesce(x > v, F.lit(False))
            out = later | (x.eqNullSafe(v) & out)
        return out

    return [no_sooner(found[a]) for a in at]




def fold_bounds(n: int, k: int = N_SPLITS) -> list[tuple[int, int, int]]:
    """V1: (train_end, val_start, val_end) per fold for forward chaining over n ordered rows.

    Validation blocks have ``s = n div (k+1)`` rows; fold i trains on [0, n-k*s+i*s)."""
    s = n // (k + 1)
    if s == 0:
        raise ValueError(f"{n} rows cannot make {k} forward folds")
    base = n - k * s
    return [(base + i * s, base + i * s, base + (i + 1) * s) for i in range(k)]


def literal_members(pairs: list[tuple[int, str]]) -> Column:
    """An array of (fold, role) pairs that Spark makes once, not for every row."""
    return F.array(*[F.struct(F.lit(f).cast("bigint").alias("fold"), F.lit(role).alias("role")) for f, role in pairs])


def forward_chain_members(df_pos: DataFrame, n: int, k: int = N_SPLITS, pos: str = "pos") -> DataFrame:
    """V1: every positioned labelled row with an array ``members`` of its (fold, role) pairs."""
    s = n // (k + 1)
    if s == 0:
        raise ValueError(f"{n} labelled rows cannot make {k} forward folds")
    base = n - k * s
    # one of k + 1 literal arrays: block b trains in the folds from b on and validates in fold b - 1
    members = F.array(*[literal_members([*((f, "train") for f in range(b, k)), *([(b - 1, "val")] if b else [])]) for b in range(k + 1)])
    block = F.when(F.col(pos) < base, 0).otherwise(F.floor((F.col(pos) - base) / s) + 1).cast("int")
    return df_pos.withColumn("members", F.element_at(members, F.least(block, F.lit(k)) + 1))


def forward_chain_roles(df_pos: DataFrame, n: int, k: int = N_SPLITS, pos: str = "pos") -> DataFrame:
    """V1: explode every positioned labelled row into its (fold, role) memberships."""
    out = forward_chain_members(df_pos, n, k, pos)
    return out.select(*df_pos.columns, F.inline("members"))


def last_and_full_members(members: DataFrame, last: int, full: int = -1) -> DataFrame:
    """M5: of the pairs of a row only those of fold ``last`` stay, and every row trains in the fold ``full`` of all labelled rows."""
    whole = F.struct(F.lit(full).cast("bigint").alias("fold"), F.lit("train").alias("role"))
    return members.withColumn("members", F.concat(F.filter("members", lambda m: m["fold"] == last), F.array(whole)))


def with_test_members(members: DataFrame, unlabelled: DataFrame, k: int = N_SPLITS) -> DataFrame:
    """Unlabelled rows with role ``test`` in every fold, unexploded."""
    return members.unionByName(unlabelled.withColumn("members", literal_members([(f, "test") for f in range(k)])), allowMissingColumns=True)


def with_test_rows(fold_rows: DataFrame, unlabelled: DataFrame, k: int = N_SPLITS) -> DataFrame:
    """Unlabelled rows join every fold with role ``test`` (they are scored by every fold model)."""
    t = unlabelled.withColumn("fold", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint")))) \
        .withColumn("role", F.lit("test"))
    return fold_rows.unionByName(t, allowMissingColumns=True)


def full_fit_roles(labelled: DataFrame, unlabelled: DataFrame | None = None, fold: int = -1) -> DataFrame:
    """M6 / M5 mode: one 'fold' where every labelled row trains and unlabelled rows are scored."""
    out = labelled.withColumn("fold", F.lit(fold).cast("bigint")).withColumn("role", F.lit("train"))
    if unlabelled is not None:
        out = out.unionByName(unlabelled.withColumn("fold", F.lit(fold).cast("bigint"))
                              .withColumn("role", F.lit("test")), allowMissingColumns=True)
    return out


def group_folds(df: DataFrame, code_col: str, k: int = N_SPLITS) -> DataFrame:
    """V2: fold by group — ``code mod k`` of the group's dense rank (or pass a hash column)."""
    return df.withColumn("fold", F.pmod(F.col(code_col), F.lit(k)).cast("bigint"))


def hash_group_folds(df: DataFrame, entity: str, k: int = N_SPLITS) -> DataFrame:
    """V2 at scale: fold = pmod(xxhash64(entity), k) — no ranking pass needed."""
    return df.withColumn("fold", F.pmod(F.xxhash64(entity), F.lit(k)).cast("bigint"))


def time_holdout(df: DataFrame, t: str, cutoff: int) -> DataFrame:
    """V3: role = train before/at the cutoff, test after it."""
    return df.withColumn("role", F.when(F.col(t) <= cutoff, F.lit("train")).otherwise(F.lit("test")))


def with_target_share(fold_rows: DataFrame, day: str, target_day: int, row_id: str, every: int,
                      k: int = N_SPLITS) -> DataFrame:
    """V4: move every ``every``-th target-period row (by row id) out of validation and into the
    training role of all folds, so models see target-period rows during training."""
    picked = (F.col(day) >= target_day) & (F.pmod(F.col(row_id), F.lit(every)) == 0)
    kept = fold_rows.where(~(picked & F.col("role").isin("train", "val")))
    moved = (fold_rows.where(picked & (F.col("role") == "val")).drop("fold", "role")
             .withColumn("fold", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint"))))
             .withColumn("role", F.lit("train")))
    return kept.unionByName(moved)


def _fmt_key(key: Column) -> Column:
    d = F.floor(key / 10000)
    h = F.floor((key % 10000) / 100)
    m = key % 100
    return F.format_string("day%d %02d:%02d", d.cast("int"), h.cast("int"), m.cast("int"))


def fold_report(fold_rows: DataFrame, key: str = "sort_key") -> DataFrame:
    """Rows and first/last (day, H:M) per (fold, role)."""
    return (fold_rows.groupBy("fold", "role")
            .agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.min(key).alias("_lo"), F.max(key).alias("_hi"))
            .select("fold", "role", "rows", _fmt_key(F.col("_lo")).alias("first"),
                    _fmt_key(F.col("_hi")).alias("last")))
