"""Verdicts from tables of reviewers' answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def verdict_two_pass(stored: Column, p1: Column, about1: Column, p2: Column, about2: Column, quote_ok: Column) -> Column:
    """Verdict from two passes: the second decides where the first doesn't confirm the stored key."""
    return (
        F.when(p1.isNull(), "NOT_AUDITED").when((p1 == stored) & (about1 == "S"), "OK").when(p2.isNull(), "UNDECIDED").when((p2 == stored) & (about2 == "S"), "OK_P2").when(about2 == "N", "REVIEW_ARTICLE")
        .when(p2 == "?", "UNDECIDED").when((p2 == p1) & quote_ok, "ERROR_KEY").otherwise("REVIEW_KEY")
    )


def verdict_matrix(states: Column, key: Column) -> Column:
    """From a map of option letter to T, F or ?: confirmed, proven error, or undecidable, with the first failing reason."""
    values = F.transform(F.array(*map(F.lit, "ABCD")), lambda c: F.coalesce(F.try_element_at(states, c), F.lit("?")))
    true = F.size(F.filter(values, lambda v: v == "T"))
    own = F.coalesce(F.try_element_at(states, key), F.lit("?"))
    return F.when(F.array_contains(values, "?"), "UNDECIDABLE:OPEN").when(true == 0, "UNDECIDABLE:NONE").when(true > 1, "UNDECIDABLE:SEVERAL").when(own == "T", "CONFIRMED").otherwise("PROVEN_ERROR")


def two_audits(first: Column, second: Column, stored: Column) -> Column:
    """A second audit only if the first doesn't confirm; an error needs both to agree on a letter."""
    return F.when(first == stored, "CONFIRMED").when(second.isNull(), "PENDING").when(second == stored, "DISPUTED").when((first == second) & (first != "?"), "ERROR").otherwise("UNDECIDED")


def two_of_three(a: Column, b: Column, c: Column) -> Column:
    """Struct ``(verdict, disputed)``: the majority, the third where all differ."""
    pair = F.when(a == b, a).when(a == c, a).when(b == c, b)
    return F.struct(F.coalesce(pair, c).alias("verdict"), ((a != b) | (b != c)).alias("disputed"))


def third_pass_class(stored: Column, earlier: Column, third: Column) -> Column:
    return F.when(third.isNull() | (third == "?"), "UNDECIDED").when(third == earlier, "CONFIRMS").when(third == stored, "RECOVERS").otherwise("THIRD")


def validation_passed(marks: list[Column]) -> Column:
    """Struct ``(passed, contradiction)``: all marks hold; some but not all do."""
    n = sum(F.coalesce(m.cast("int"), F.lit(0)) for m in marks)
    return F.struct((n == len(marks)).alias("passed"), ((n > 0) & (n < len(marks))).alias("contradiction"))


def accept_answer(legal: Column, candidate: Column, quote_found: Column, in_force: Column, other: Column, key: Column) -> Column:
    """First reason to refuse, or ACCEPTED."""
    return (
        F.when(~F.coalesce(legal, F.lit(False)), "NOT_LEGAL").when(candidate.isNull(), "NO_ARTICLE").when(~F.coalesce(quote_found, F.lit(False)), "QUOTE").when(F.coalesce(in_force, F.lit("")) != "SI", "NOT_IN_FORCE")
        .when(other.isNotNull() & (other != key), "OTHER_KEY").otherwise("ACCEPTED")
    )


def verdict_pivot(rows: DataFrame, by: str, verdict: str, values: list[str]) -> DataFrame:
    """Counts by group and verdict with a total row (null group), in one aggregation."""
    n = [F.count_if(F.col(verdict) == v).alias(v.lower()) for v in values]
    return rows.rollup(by).agg(*n, F.count("*").alias("total"))


def latest_checkpoint(log: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last record per key of an append log."""
    others = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("r")).select(*keys, "r.*")


def validity_group_apply(items: DataFrame, group: list[str], quality: list[Column]) -> DataFrame:
    """One representative per group, the best by quality, decides for all; members that already agree are skipped."""
    best = items.groupBy(*group).agg(F.max_by(F.struct("validity", "item_id"), F.struct(*quality)).alias("best"))
    on = [items[g].eqNullSafe(best[g]) for g in group]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    met = items.join(best, cond).select("item_id", items["validity"], F.col("best.validity").alias("new_validity"), F.col("best.item_id").alias("decided_by"))
    return met.filter(~F.col("validity").eqNullSafe(F.col("new_validity")))


def normalise_answer(state: Column, fields: list[Column], evidence: Column, text: Column) -> Column:
    """Approved or corrected only with all fields and evidence of 12 or more characters that stands in the text; else unresolved."""
    full = F.lit(True)
    for f in fields:
        full = full & (F.trim(F.coalesce(f, F.lit(""))) != "")
    return F.when(state.isin("APPROVED", "CORRECTED") & full & (F.length(evidence) >= 12) & text.contains(evidence), state).otherwise("UNRESOLVED")


def batch_check(asked: DataFrame, answered: DataFrame) -> DataFrame:
    """Per batch: items missing from, foreign to, or invalid in the answers."""
    a = asked.groupBy("batch").agg(F.collect_set("item_id").alias("asked"))
    b = answered.groupBy("batch").agg(F.collect_set("item_id").alias("got"), F.count_if(~F.coalesce(F.col("answer").isin("A", "B", "C", "D", "?"), F.lit(False))).alias("invalid"))
    met = a.join(b, "batch", "left")
    none = F.array().cast("array<bigint>")
    return met.select("batch", F.size(F.array_except("asked", F.coalesce("got", none))).alias("missing"), F.size(F.array_except(F.coalesce("got", none), "asked")).alias("foreign_ids"), F.coalesce("invalid", F.lit(0)).alias("invalid"))


def latest_phase_status(p1: Column, p2: Column) -> Column:
    return F.coalesce(p2, p1, F.lit("PENDING"))


def guessable_filter(candidates: DataFrame, guesses: DataFrame) -> DataFrame:
    """Drop candidates whose key was guessed without the stem."""
    met = candidates.join(guesses.select("item_id", "guess"), "item_id", "left")
    return met.filter(F.col("guess").isNull() | (F.col("guess") != F.col("answer_key"))).drop("guess")


def hash_order(*cols: Column, seed: str) -> Column:
    """A reproducible random order."""
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(seed)))


def first_per_group(rows: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= n)
