"""Subscription tables derived from the driver's TPC-H-style parquet.

The driver's data has no subscription tables, so FIXTURES.md section 2 fixes
a deterministic derivation (grain: one order = one charge). The oracle SQL in
`recurra.plans.oracle` writes the same derivation in DuckDB. Every derived
table grows with `orders` / `customer`; only small dimensions (product names,
price grid, calendar) are generated from rules.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, PriceRules
from ..session import materialize
from .calendar import day_calendar
from .tables import Inputs

# Fixed fixture values (FIXTURES.md section 2).
FIXTURE_PRODUCTS = [
    ("P0", "Kettle"),
    ("P1", "Lantern"),
    ("P2", "Kettle Lessons"),
    ("P3", "Anvil"),
    ("P9", "Feather"),  # a dimension product without orders
    ("P1", "Lantern"),  # a row twice: its orders fan out, as a dirty dimension makes them
]
FIXTURE_GRID_CURRENCIES = ["USD", "AUD", "GBP", "EUR", "NZD"]
FIXTURE_GRID_PRODUCTS = ["Kettle", "Lantern", "Kettle Lessons", "Anvil"]
FIXTURE_GRID_ACCESS = ["MULTI USER", "single user"]
FIXTURE_GRID_OMIT = ("EUR", "Lantern")
FIXTURE_GRID_BASE = (400, 900, 1600)
FIXTURE_CALENDAR = (dt.date(1994, 12, 1), dt.date(2005, 12, 31))
FIXTURE_OVERRIDE_COMPANY = "C6"
FIXTURE_AS_OF = dt.date(2001, 1, 1)
FIXTURE_CURRENCIES = ["USD", "AUD", "GBP", "EUR", " nzd ", "XXX", None]  # by k % 7
FIXTURE_TERMS = ["YEARLY", "monthly", "Three Year", None]  # by k % 4


def fixture_config(**overrides) -> Config:
    rules = PriceRules(
        override_company_ids=(FIXTURE_OVERRIDE_COMPANY,),
        training_product="Kettle Lessons",
        legacy_products=tuple(FIXTURE_GRID_PRODUCTS),
    )
    base = dict(
        as_of=FIXTURE_AS_OF,
        price_rules=rules,
        batch_product_map={k: v for k, v in FIXTURE_PRODUCTS[:4]},
    )
    base.update(overrides)
    return Config(**base)


def _pm(k: Column, n: int) -> Column:
    return F.pmod(k, F.lit(n))


def _s(c: Column) -> Column:
    return c.cast("string")


def _hours(ts: Column, h: Column) -> Column:
    return F.timestamp_add("HOUR", h, ts)


def _days(ts: Column, d) -> Column:
    return F.timestamp_add("DAY", d if isinstance(d, Column) else F.lit(d), ts)


def _at_midnight(d: Column) -> Column:
    return d.cast("timestamp_ntz")


def _by_index(idx: Column, values: list) -> Column:
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        out = F.when(idx == i, lit) if out is None else out.when(idx == i, lit)
    return out


def derive_transactions(orders: DataFrame) -> DataFrame:
    """transactions_raw: one charge per order plus refund/duplicate copies.

    One scan of `orders`; the copies come from a generator (narrow, no
    union of repeated scans).
    """
    k = F.col("o_orderkey")
    od = F.col("o_orderdate").cast("timestamp_ntz")
    d = F.to_date(od)
    m10 = _pm(k, 10)
    m20 = _pm(k, 20)
    start = _hours(od, _pm(k, 24))
    end_day = (
        F.when(m10 <= 2, F.add_months(d, 1))
        .when(m10 <= 6, F.add_months(d, 12))
        .when(m10 == 7, F.add_months(d, 36))
        .when(m10 == 8, F.date_add(d, (F.lit(20) + _pm(k, 300)).cast("int")))
    )
    end = (
        F.when(m20 == 9, start)
        .when(m20 == 19, _days(od, -5))
        .otherwise(_hours(_at_midnight(end_day), _pm(k * 7, 24)))
    )
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    amount = (
        F.when(_pm(k, 17) == 0, F.lit(0.0))
        .when(_pm(k, 53) == 0, F.lit(None).cast("double"))
        .otherwise(F.floor((cents + 50) / 100).cast("double") / F.lit(100.0))
    )
    base_type = (
        F.when(_pm(k, 29) == 0, F.lit(None).cast("string"))
        .when(_pm(k, 2) == 0, F.lit("Charge"))
        .otherwise(F.lit("Payment"))
    )
    kinds = F.filter(
        F.array(
            F.lit("T"),
            F.when(_pm(k, 11) == 0, F.lit("R")),
            F.when(_pm(k, 77) == 0, F.lit("S")),
            F.when(_pm(k, 143) == 0, F.lit("D")),
            F.when(_pm(k, 13) == 5, F.lit("U")),
        ),
        lambda x: x.isNotNull(),
    )
    base = orders.select(
        k.alias("_k"),
        F.col("o_custkey").alias("_ck"),
        od.alias("_od"),
        start.alias("periodstart"),
        end.alias("periodend"),
        amount.alias("_amount"),
        base_type.alias("_type"),
        F.explode(kinds).alias("_kind"),
    )
    kind = F.col("_kind")
    kk = F.col("_k")
    shift = (
        F.when(kind == "R", 10).when(kind == "S", 12).when(kind == "D", 1)
        .when(kind == "U", 15).otherwise(0)
    )
    return base.select(
        F.concat(kind, _s(kk)).alias("id"),
        F.concat(F.lit("C"), _s(F.col("_ck"))).alias("currentbillingentityid"),
        _days(F.col("_od"), shift).alias("DATE"),
        "periodstart",
        "periodend",
        F.when(kind == "U", F.col("_amount") + 1).otherwise(F.col("_amount")).alias("originalamount"),
        _by_index(_pm(kk, 7), FIXTURE_CURRENCIES).alias("originalcurrencycode"),
        F.concat(F.lit("L"), _s(F.col("_ck")), F.lit("-"), _s(_pm(kk, 3))).alias("objectid"),
        F.concat(F.lit("P"), _s(_pm(kk, 5))).alias("objecttypeid"),
        F.when(_pm(kk, 2) == 0, "Multi User").otherwise("Single User").alias("objectaccesstype"),
        F.when(kind == "T", F.col("_type"))
        .when(kind == "R", "Refund")
        .when(kind == "S", "refund")
        .when(kind == "D", "Charge")
        .otherwise("Refund")
        .alias("type"),
        F.when(_pm(kk, 3) == 0, "Stripe").otherwise("Manual").alias("source"),
        F.concat(F.lit("X"), _s(_pm(kk, 4))).alias("connectedto"),
        kk.alias("_k"),
        F.col("_ck"),
    )


def derive_company(customer: DataFrame) -> DataFrame:
    ck = F.col("c_custkey")
    nk = _s(F.col("c_nationkey"))
    cc = (
        F.when(_pm(ck, 19) == 0, F.lit(None).cast("string"))
        .when(_pm(ck, 2) == 0, F.concat(F.lower(F.concat(F.lit("n"), nk)), F.lit(" ")))
        .otherwise(F.concat(F.lit("N"), nk))
    )
    return customer.select(
        F.concat(F.lit("C"), _s(ck)).alias("id"),
        F.concat(F.lit(" "), F.lower("c_name"), F.lit(" ")).alias("name"),
        F.col("c_mktsegment").alias("classification"),
        cc.alias("countrycode"),
        F.concat(F.lit("st"), _s(_pm(ck, 7))).alias("state"),
        F.concat(F.lit("city"), _s(_pm(ck, 11))).alias("city"),
    )


def derive_region(nation: DataFrame) -> DataFrame:
    return nation.filter(_pm(F.col("n_nationkey"), 8) != 7).select(
        F.concat(F.lit("N"), _s(F.col("n_nationkey"))).alias("country_code"),
        F.col("n_name").alias("country"),
    )


def derive_legacy_licenses(customer: DataFrame) -> DataFrame:
    ck = F.col("c_custkey")
    return customer.filter(_pm(ck, 3) == 0).select(
        F.concat(F.lit("L"), _s(ck), F.lit("-0")).alias("licenseid")
    )


def literal_table(spark: SparkSession, rows: list[tuple], schema: list[tuple[str, str]]) -> DataFrame:
    """A small constant table built in the JVM (no Python worker on scan)."""
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, schema)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def product_dim(spark: SparkSession) -> DataFrame:
    return literal_table(spark, FIXTURE_PRODUCTS, [("objecttypeid", "string"), ("product", "string")])


def price_grid(spark: SparkSession) -> DataFrame:
    rows = []
    for i, cur in enumerate(FIXTURE_GRID_CURRENCIES):
        for prod in FIXTURE_GRID_PRODUCTS:
            if (cur, prod) == FIXTURE_GRID_OMIT:
                continue
            for acc in FIXTURE_GRID_ACCESS:
                th = [float(b * (10 + i)) / 10 for b in FIXTURE_GRID_BASE]
                rows.append((cur, prod, acc, *th))
    return literal_table(
        spark,
        rows,
        [("currency_code", "string"), ("product", "string"), ("objectaccesstype", "string"),
         ("price_th1", "double"), ("price_th2", "double"), ("price_th3", "double")],
    )


def derive_classified(txn_with_k: DataFrame, customer: DataFrame) -> DataFrame:
    """classified_transactions (batch generation) from the derived rows."""
    k = F.col("_k")
    names = customer.select(F.col("c_custkey").alias("_ck"), F.col("c_name").alias("_cn"))
    t = txn_with_k.join(names, "_ck", "left")
    is_refund = F.coalesce(F.lower("type") == "refund", F.lit(False))
    return t.select(
        "id",
        "currentbillingentityid",
        "DATE",
        F.col("originalamount").alias("transactionarr"),
        _by_index(_pm(k, 4), FIXTURE_TERMS).alias("termlength"),
        F.when(_pm(k, 50) == 0, F.concat(F.col("_cn"), F.lit(" II")))
        .otherwise(F.col("_cn"))
        .alias("customername"),
        "objecttypeid",
        "type",
        F.when(~is_refund & (_pm(k, 11) == 0), F.concat(F.lit("R"), _s(k)))
        .alias("matchingrefund"),
    )


FACTS = ("transactions", "classified")
_PREPARED: dict[tuple[str, str], Inputs] = {}
_WRITTEN: dict[tuple[str, str], set[str]] = {}


def fixture_inputs(spark: SparkSession, sf_dir: str, prepare: bool = True, facts: tuple[str, ...] = FACTS) -> Inputs:
    """Subscription tables derived from the driver's parquet in `sf_dir`.

    With `prepare` the derived fact tables (companies, and of transactions and
    classified transactions those named in `facts`) are written once per
    session and directory to the shared checkpoint folder and read back, so
    later queries scan tables as a production run would instead of re-deriving
    them in every branch of their plans.
    """
    app = spark.sparkContext.applicationId
    key = (app, os.path.abspath(sf_dir))
    if prepare and key in _PREPARED:
        return _write_facts(key, facts)

    def rd(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # The driver's fact file is one small file; a transactions table is many.
    orders = rd("orders").repartition(spark.sparkContext.defaultParallelism)
    customer = rd("customer")
    txn_k = derive_transactions(orders)
    company = derive_company(customer)
    classified = derive_classified(txn_k, customer)
    txn = txn_k.drop("_k", "_ck")
    if prepare:
        company = materialize(company, "fixture-company")
    inputs = Inputs(
        transactions=txn,
        company=company,
        product_dim=product_dim(spark),
        price_grid=price_grid(spark),
        legacy_licenses=derive_legacy_licenses(customer),
        calendar=day_calendar(spark, *FIXTURE_CALENDAR),
        region_dim=derive_region(rd("nation")),
        classified=classified,
        batch_company=company,
    )
    if not prepare:
        return inputs
    _PREPARED[key], _WRITTEN[key] = inputs, set()
    return _write_facts(key, facts)


def _write_facts(key: tuple[str, str], facts: tuple[str, ...]) -> Inputs:
    for name in facts:
        if name not in _WRITTEN[key]:
            written = materialize(getattr(_PREPARED[key], name), f"fixture-{name}")
            _PREPARED[key] = replace(_PREPARED[key], **{name: written})
            _WRITTEN[key].add(name)
    return _PREPARED[key]
