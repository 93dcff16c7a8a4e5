"""The daily rebuild: DataFrames over stage tables.

Asking for an output writes the stage tables it needs (sliced orders, spans,
customer-months, customer facts, ...) while the plan is built; the output
itself is lazy over them. `publish` writes all outputs and deletes the stage
tables.

    transactions --refund_sets--> clean map / unmatched
         |                               |
         +--stage_orders--> staged ------+--> refunded / not refunded / trial
                               |
                    slice_orders (All + every product, `for_product` key)
                               |
        spans, customer-months --> labelled months --> rollforward
                                          |
                                   customer facts --> arr_final

The source runs staging -> ARR -> rollforward once for "All" and once per
product, serially. Here the product is a key column of one plan, so every
shuffle serves all slices at once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import from_micros
from ..operators import arr as arr_ops
from ..operators import batch as batch_ops
from ..operators import facts, legacy, refunds, rollforward, staging
from ..operators.monthly import arr_by_month, with_active_run
from ..session import bucket_count, delete_folder, drop_stage, folder_bytes, materialize, materialize_bucketed
from ..sources.calendar import SpineBounds
from ..sources.catalog import TableStore
from ..sources.sinks import RUN_PREFIX, switch, write_table
from ..sources.tables import Inputs


@dataclass
class Pipeline:
    inputs: Inputs
    cfg: Config
    products: bool = True  # False: the "All" slice only

    @property
    def spark(self):
        return self.inputs.transactions.sparkSession

    @cached_property
    def refund_sets(self) -> refunds.RefundSets:
        return refunds.RefundSets(self.inputs.transactions, self._cut)

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        if not self.cfg.materialize:
            return df
        out = materialize(df, name, self._written)
        self._paths[name] = self._written[-1]
        return out

    @cached_property
    def _paths(self) -> dict[str, str]:
        return {}

    def _parts(self, of: str) -> int:
        """Parts that orders and all that follows lie in; `of` is the stage the
        orders come from, each row of which is in at most two slices."""
        if not self.cfg.materialize:
            return int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return bucket_count(self.spark, 2 * folder_bytes(self.spark, self._paths[of]))

    def _bucketed(self, df: DataFrame, name: str, parts: int) -> DataFrame:
        """A stage cut of rows that lie by `staging.LIE`."""
        if not self.cfg.materialize:
            return df
        return materialize_bucketed(df, name, staging.LIE, parts, self._written)

    def _repeated(self, rows: DataFrame, hot: DataFrame, name: str) -> DataFrame | None:
        """Rows with too many copies for one task, if there are any."""
        if hot.isEmpty():
            return None
        often = self._cut(staging.repeated_rows(rows, hot, self.cfg.hot_orders), name)
        return None if often.isEmpty() else often

    def _stretched(self, laid: DataFrame, rows: DataFrame, hot: DataFrame, parts: int) -> DataFrame:
        """`laid` orders, of `rows`, with their end dates stretched."""
        if self.cfg.grace_days == 0:
            return laid
        starts = None if hot.isEmpty() else staging.hot_starts(rows, hot, parts)
        return staging.stretch_end_dates(laid, self.cfg.grace_days, starts)

    @cached_property
    def _written(self) -> list[str]:
        return []

    def drop_stages(self) -> None:
        """Delete the stage tables; DataFrames taken from here no longer work."""
        while self._written:
            drop_stage(self.spark, self._written.pop())

    @cached_property
    def staged(self) -> DataFrame:
        """Every transaction staged once, tagged with its refund links."""
        i = self.inputs
        rs = self.refund_sets
        txn = staging.flag_refund_links(i.transactions, rs.clean, rs.unmatched)
        s = staging.stage_orders(txn, i.company, i.product_dim, self.cfg)
        content = [c for c in s.columns if c not in staging.FLAGS]
        return self._cut(s.withColumn("_h", staging.content_hash(content)), "staged")

    @cached_property
    def bounds(self) -> SpineBounds:
        return SpineBounds(self.inputs.calendar)

    @cached_property
    def slices(self) -> DataFrame:
        return rollforward.slice_list(self.spark, self.inputs.product_dim if self.products else None)

    @cached_property
    def orders(self) -> DataFrame:
        """Sliced orders with adjusted end date: read by every later stage."""
        o = staging.slice_orders(self.staged, self.inputs.region_dim, self.products)
        o = o.drop("_cost", "_dim_product", *staging.FLAGS)  # their use is over; `_h` knows them
        repeated = self._repeated(self.staged, self.hot, "repeated")
        laid = staging.lay_orders(o.drop("totalordercost"), self.hot, repeated, self.parts)
        laid = self._stretched(laid, staging.in_slices(self.staged, self.products), self.hot, self.parts)
        laid = laid.withColumn("totalordercost", from_micros(F.col("_cost_u")))  # made anew where they lie, not moved
        return self._bucketed(with_active_run(laid, self.bounds), "orders", self.parts)

    @cached_property
    def parts(self) -> int:
        self.staged  # noqa: B018  (its size is asked for)
        return self._parts("staged")

    @cached_property
    def hot(self) -> DataFrame:
        """Customers whose orders are dealt to several tasks."""
        keys = staging.in_slices(self.staged, self.products)
        return self._cut(staging.hot_customers(keys, self.cfg.hot_orders), "hot-customers")

    @cached_property
    def arr_monthly(self) -> DataFrame:
        return arr_by_month(self.orders, self.bounds, keep_monthless=True)

    @cached_property
    def spans(self) -> DataFrame:
        return self._cut(rollforward.customer_spans(self.orders), "spans")

    @cached_property
    def ccm(self) -> DataFrame:
        """(slice, customer, company, month) ARR facts, shared by the
        rollforward and the ARR table."""
        om = arr_by_month(self.orders, self.bounds, keep_monthless=False)
        return arr_ops.customer_company_months(om, self.parts)

    @cached_property
    def labelled(self) -> DataFrame:
        return rollforward.labelled_months(self.spans, self.ccm, self.slices, self.bounds, self.parts)

    @cached_property
    def rollforward(self) -> DataFrame:
        return rollforward.rollforward(self.labelled, self.cfg.source_label)

    @cached_property
    def arr_final_full(self) -> DataFrame:
        facts = arr_ops.all_customer_runs(
            self.orders, self.spans, self.hot, self.slices, self.bounds, self.parts, arr_ops.PROCEDURE
        )
        facts = self._bucketed(staging.lay_facts(facts, self.hot, self.parts), "customer-facts", self.parts)
        return arr_ops.arr_rows(self.orders, facts, self.spans, self.hot, self.bounds, self.parts, arr_ops.PROCEDURE)

    @cached_property
    def arr_final(self) -> DataFrame:
        return arr_ops.public(self.arr_final_full, arr_ops.PROCEDURE)

    # --- refund / trial facts (whole business only) ---------------------
    def refunded_arr(self) -> DataFrame:
        i = self.inputs
        return facts.refunded_arr(self.staged, i.calendar, i.region_dim)

    def not_refunded_arr(self) -> DataFrame:
        return facts.not_refunded_arr(self.staged, self.bounds, self.inputs.region_dim)

    def trial_arr(self) -> DataFrame:
        i = self.inputs
        return facts.trial_arr(self.staged, i.calendar, i.region_dim)

    # --- legacy licences -------------------------------------------------
    @cached_property
    def licence_facts(self) -> DataFrame:
        return self._cut(legacy.licence_facts(self.inputs.transactions), "licence-facts")

    @cached_property
    def license_summary(self) -> DataFrame:
        i = self.inputs
        return legacy.license_summary(self.licence_facts, i.company, i.legacy_licenses, i.product_dim, i.region_dim)

    @cached_property
    def legacy_tracker(self) -> DataFrame:
        tracker = legacy.legacy_tracker(self.license_summary, self.inputs.price_grid, self.cfg.price_rules)
        return self._cut(tracker, "legacy-tracker")

    def churn_for_legacy(self) -> DataFrame:
        i = self.inputs
        return legacy.churn_for_legacy(i.transactions, self.licence_facts, self.legacy_tracker, i.company, i.product_dim, self.cfg.as_of)

    # --- batch generation --------------------------------------------------
    @cached_property
    def batch_staged(self) -> DataFrame:
        """The batch generation's paid orders, staged once."""
        i = self.inputs
        o = batch_ops.batch_orders(i.classified, i.batch_company, self.cfg)
        return self._cut(o.withColumn("_h", staging.content_hash(o.columns)), "batch-staged")

    @cached_property
    def batch_orders(self) -> DataFrame:
        # as in `orders`: what only `_h` still needs, or can be made anew, is not moved
        o = self.batch_staged.drop("transactionarr", "type", "matchingrefund", "totalordercost")
        laid = staging.lay_orders(o, self.batch_hot, self._repeated(o, self.batch_hot, "batch-repeated"), self.batch_parts)
        laid = self._stretched(laid, o, self.batch_hot, self.batch_parts)
        laid = laid.withColumn("totalordercost", from_micros(F.col("_cost_u")))
        return self._bucketed(with_active_run(laid, self.bounds), "batch-orders", self.batch_parts)

    @cached_property
    def batch_parts(self) -> int:
        self.batch_staged  # noqa: B018  (its size is asked for)
        return self._parts("batch-staged")

    @cached_property
    def batch_hot(self) -> DataFrame:
        return self._cut(staging.hot_customers(self.batch_staged, self.cfg.hot_orders), "batch-hot-customers")

    @cached_property
    def batch_spans(self) -> DataFrame:
        return self._cut(rollforward.customer_spans(self.batch_orders), "batch-spans")

    @cached_property
    def batch_ccm(self) -> DataFrame:
        return batch_ops.batch_customer_months(self.batch_orders, self.bounds, self.batch_parts)

    @cached_property
    def batch_labelled(self) -> DataFrame:
        return batch_ops.batch_labelled_months(
            self.batch_spans, self.batch_ccm, self.inputs.classified, self.bounds, self.batch_parts
        )

    def batch_rollforward(self) -> DataFrame:
        return rollforward.rollforward(self.batch_labelled, self.cfg.source_label)

    def batch_refunded_arr(self) -> DataFrame:
        i = self.inputs
        return batch_ops.batch_refunded_arr(i.classified, i.batch_company, self.batch_spans, i.calendar, self.cfg)

    def batch_arr_final(self) -> DataFrame:
        facts = arr_ops.all_customer_runs(
            self.batch_orders, self.batch_spans, self.batch_hot, rollforward.slice_list(self.spark), self.bounds,
            self.batch_parts, arr_ops.BATCH, batch_ops.batch_first_dates(self.inputs.classified),
        )
        facts = self._bucketed(staging.lay_facts(facts, self.batch_hot, self.batch_parts), "batch-customer-facts", self.batch_parts)
        rows = arr_ops.arr_rows(
            self.batch_orders, facts, self.batch_spans, self.batch_hot, self.bounds, self.batch_parts, arr_ops.BATCH
        )
        return arr_ops.public(rows, arr_ops.BATCH)

    def batch_outputs(self) -> dict[str, DataFrame]:
        """The batch generation's tables; `batch_product_map` must be set."""
        if not self.cfg.batch_product_map:
            raise ValueError("Config.batch_product_map is empty: every batch order would be an add-on")
        return {
            "batch_arr_final": self.batch_arr_final(),
            "batch_rollforward": self.batch_rollforward(),
            "batch_refunded_arr": self.batch_refunded_arr(),
        }

    def outputs(self, batch: bool = True) -> dict[str, DataFrame]:
        """Every table the daily run publishes; the batch generation's too,
        where its inputs are there and `batch` is set."""
        out = {
            "arr_final": self.arr_final,
            "arr_rollforward": self.rollforward,
            "refunded_arr": self.refunded_arr(),
            "not_refunded_arr": self.not_refunded_arr(),
            "trial_arr": self.trial_arr(),
            "legacy_tracker": self.legacy_tracker,
            "churn_for_legacy": self.churn_for_legacy(),
        }
        if batch and self.inputs.classified is not None and self.inputs.batch_company is not None:
            out |= self.batch_outputs()
        return out

    def publish(self, base: str) -> str:
        """Write every output into a fresh folder below `base`, then point
        `base/current` (a one-row table of the folder's name) at it, and
        delete the stage tables. A reader that resolves `current` first sees
        either the former run whole or this one whole. A run that fails leaves
        no folder; what a lost driver leaves, and former runs, go by
        `sinks.expire_runs`."""
        run = f"{RUN_PREFIX}{uuid.uuid4().hex}"
        try:
            for name, df in self.outputs().items():
                write_table(df, f"{base}/{run}/{name}", ["for_product"] if "for_product" in df.columns else None)
            switch(self.spark, base, run)
        except BaseException:
            delete_folder(self.spark, f"{base}/{run}")
            raise
        finally:
            self.drop_stages()
        return f"{base}/{run}"

    def publish_tables(self, database: str) -> str:
        """The same into the session's catalog: `database.arr_final` and so on
        are views that are switched to the new run's tables when all of these
        are written (`sources.catalog.TableStore`); returns the run."""
        try:
            return TableStore(self.spark, database).publish(self.outputs())
        finally:
            self.drop_stages()
