"""Refund matching.

A refund is paired with a charge when customer, billing period, amount and
licence are all equal. Pairs that are ambiguous in either direction are
moved to the unmatched set. Everything is equi-joins and aggregates on the
transaction table; nothing depends on the product slice, so it runs once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_charge_type, is_refund_type, truthy

PAIR_KEY = ("currentbillingentityid", "periodstart", "periodend", "originalamount", "objectid")
PAIR_COLUMNS = ("refund_id", "key_col", "charge_id", "originalamount")


def key_col(prefix: str = "") -> Column:
    """Display key `entity|start|end|amount|licence` (NULL if any part is)."""
    parts = []
    for i, c in enumerate(PAIR_KEY):
        if i:
            parts.append(F.lit("|"))
        parts.append(F.col(prefix + c).cast("string"))
    return F.concat(*parts)


def _refunds(txn: DataFrame) -> DataFrame:
    return txn.filter(truthy(is_refund_type("type") & (F.col("originalamount") > 0)))


def _charges(txn: DataFrame) -> DataFrame:
    """Charge side of the match, key columns renamed `c_*`."""
    return txn.filter(truthy(is_charge_type("type") & (F.col("originalamount") > 0))).select(
        F.col("id").alias("charge_id"), *[F.col(c).alias("c_" + c) for c in PAIR_KEY]
    )


def _on(left: DataFrame, right: DataFrame) -> Column:
    cond = None
    for c in PAIR_KEY:
        e = left[c] == right["c_" + c]
        cond = e if cond is None else cond & e
    return cond


def refund_match(txn: DataFrame) -> DataFrame:
    """(refund_id, key_col, charge_id, originalamount) for every pair."""
    r = _refunds(txn)
    c = _charges(txn)
    return r.join(c, _on(r, c), "inner").select(
        F.col("id").alias("refund_id"), key_col().alias("key_col"), "charge_id", "originalamount"
    )


def ambiguous_ends(pairs: DataFrame) -> DataFrame:
    """(end, id, n): the refunds paired with more than one distinct charge and
    the charges paired with more than one distinct refund, from one pass over
    the pairs (each is looked at from both of its ends)."""
    ends = F.explode(
        F.array(
            F.struct(F.lit("refund").alias("end"), F.col("refund_id").alias("id"), F.col("charge_id").alias("other")),
            F.struct(F.lit("charge").alias("end"), F.col("charge_id").alias("id"), F.col("refund_id").alias("other")),
        )
    )
    degrees = pairs.select(ends.alias("e")).groupBy("e.end", "e.id").agg(F.countDistinct("e.other").alias("n"))
    return degrees.filter(F.col("n") > 1)


def dup_refunds(ends: DataFrame) -> DataFrame:
    """Refunds paired with more than one distinct charge."""
    return ends.filter("end = 'refund'").select(F.col("id").alias("refund_id"), "n")


def dup_charges(ends: DataFrame) -> DataFrame:
    """Charges paired with more than one distinct refund."""
    return ends.filter("end = 'charge'").select(F.col("id").alias("charge_id"), "n")


def flag_pairs(pairs: DataFrame, dref: DataFrame, dchg: DataFrame) -> DataFrame:
    """The pairs, read once more, with `_doubtful`: either end is ambiguous."""
    r = dref.select(F.col("refund_id").alias("_d_r"))
    c = dchg.select(F.col("charge_id").alias("_d_c"))
    both = pairs.join(r, pairs["refund_id"] == r["_d_r"], "left").join(c, pairs["charge_id"] == c["_d_c"], "left")
    return both.withColumn("_doubtful", F.col("_d_r").isNotNull() | F.col("_d_c").isNotNull()).select(*PAIR_COLUMNS, "_doubtful")


def unmatched_refunds(txn: DataFrame, flagged: DataFrame) -> DataFrame:
    """Refunds without a charge, plus every pair of an ambiguous refund
    (one that has a doubtful pair).

    Both parts come from the pairs, which already hold every refund-charge
    match, so the charge side is not joined again: a refund without a pair
    (same id and key) has no charge, and with transaction ids as the key an
    ambiguous refund's rows left-joined to the charges are its pairs.
    """
    r = _refunds(txn).select(
        F.col("id").alias("refund_id"),
        key_col().alias("key_col"),
        F.lit(None).cast("string").alias("charge_id"),
        "originalamount",
    )
    matched = flagged.select(F.col("refund_id").alias("_p_id"), F.col("key_col").alias("_p_key"))
    lonely = r.join(
        matched,
        r["refund_id"].eqNullSafe(matched["_p_id"]) & r["key_col"].eqNullSafe(matched["_p_key"]),
        "left_anti",
    )
    doubtful = flagged.filter("_doubtful").select("refund_id").distinct()
    amb_rows = flagged.join(doubtful, "refund_id", "left_semi").select(*PAIR_COLUMNS)
    return lonely.unionByName(amb_rows).distinct()


def clean_refund_map(flagged: DataFrame) -> DataFrame:
    """Pairs minus ambiguous refunds and ambiguous charges."""
    return flagged.filter("NOT _doubtful").select(*PAIR_COLUMNS)


@dataclass
class RefundSets:
    """All refund sets, each made when it is asked for. `cut` may materialize
    the pairs, their ambiguous ends and the flagged pairs; the pairs are then
    read twice in all."""

    txn: DataFrame
    cut: Callable[[DataFrame, str], DataFrame] = lambda df, name: df

    @cached_property
    def pairs(self) -> DataFrame:
        return self.cut(refund_match(self.txn), "refund-pairs")

    @cached_property
    def _ends(self) -> DataFrame:
        return self.cut(ambiguous_ends(self.pairs), "refund-ends")

    @cached_property
    def dup_refunds(self) -> DataFrame:
        return dup_refunds(self._ends)

    @cached_property
    def dup_charges(self) -> DataFrame:
        return dup_charges(self._ends)

    @cached_property
    def _flagged(self) -> DataFrame:
        return self.cut(flag_pairs(self.pairs, self.dup_refunds, self.dup_charges), "refund-flags")

    @cached_property
    def unmatched(self) -> DataFrame:
        return unmatched_refunds(self.txn, self._flagged)

    @cached_property
    def clean(self) -> DataFrame:
        return clean_refund_map(self._flagged)
