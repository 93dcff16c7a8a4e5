"""Final ARR table (O23-O27): labels, synthetic churn rows, movement split,
interim churn, enrichment.

The source runs windows over *every order-month row of a customer*
(`lead`/`lag`/`sum over (partition by customer)`), which puts all of a large
customer's rows in one task. Here every window runs on customer-month
aggregates (at most one row per month and company of a customer), built with
partial aggregation, and on one exchange by (slice, customer):

    orders --explode, partial agg--> (slice, cust, company, month)
        --exchange by (slice, cust), one sort--> labels -> month totals -> gaps
        --> one row per (slice, cust, company) with an array of its runs of months

That row is joined to the *unexploded* orders, which lie bucketed by the join's
key, so the join moves facts only; each order then explodes to the months of
the array it is active in, and to the synthetic churn months it is the model
of. The array is bounded by the calendar. A hot customer's orders are dealt to
several parts of the key, and its facts copied to each.

Ties the source leaves to chance are fixed: the synthetic churn row copies
the month's smallest-ARR row, then smallest order number; the movement delta
goes to the month's first order number; where rows repeat an order, to one of
them; an order takes the label of its own company's rollforward row.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import from_micros, month_boundaries, next_month_end, truthy
from ..sources.calendar import SpineBounds
from .monthly import active_month_starts, arr_by_month
from .rollforward import SPAN, classify, labelled_months, with_first_date, with_label
from .staging import LIE, lay_dates

K4 = ["for_product", "customer_id", "company", "pivot_month"]

ARR_FINAL_COLUMNS = (
    "for_product", "pivot_month", "customer_id", "ordernumber", "orderdate", "type",
    "totalordercost", "subtypeatordertime", "company", "company_type", "countrycode",
    "state", "city", "product", "originalcurrencycode", "standardstartdate",
    "standardenddate", "standardenddate_adjusted", "arr_currency", "churn_arr_currency",
    "customer_classification", "upgrade_currency", "downgrade_currency", "new_currency",
    "reactivation_currency", "first_order_date", "transaction_source", "connectedto",
    "interim_churn_arr_currency", "country_name",
)
BATCH_ARR_FINAL_COLUMNS = (
    "for_product", "pivot_month", "customer_id", "ordernumber", "orderdate",
    "totalordercost", "subtypeatordertime", "company", "company_type", "countrycode",
    "state", "city", "product", "standardstartdate", "standardenddate",
    "standardenddate_adjusted", "arr_currency", "churn_arr_currency",
    "customer_classification", "upgrade_currency", "downgrade_currency", "new_currency",
    "reactivation_currency", "first_order_date",
)


def _ilike_churn(label: Column) -> Column:
    return label.ilike("%churn%")


def _eq_churn(label: Column) -> Column:
    return label == F.lit("Churn")


@dataclass(frozen=True)
class Variant:
    """What differs between the procedure (canonical) and batch generations."""

    attrs: tuple[str, ...]
    churn_match: Callable[[Column], Column]
    keep_monthless: bool
    interim: bool
    columns: tuple[str, ...]


PROCEDURE = Variant(
    attrs=(
        "ordernumber", "orderdate", "type", "totalordercost", "_cost_u", "subtypeatordertime",
        "company", "company_type", "countrycode", "state", "city", "product",
        "originalcurrencycode", "standardstartdate", "standardenddate",
        "standardenddate_adjusted", "transaction_source", "connectedto", "country_name",
    ),
    churn_match=_ilike_churn,
    keep_monthless=False,
    interim=True,
    columns=ARR_FINAL_COLUMNS,
)
BATCH = Variant(
    attrs=(
        "ordernumber", "orderdate", "totalordercost", "_cost_u", "subtypeatordertime",
        "company", "company_type", "countrycode", "state", "city", "product",
        "standardstartdate", "standardenddate", "standardenddate_adjusted",
    ),
    churn_match=_eq_churn,
    keep_monthless=True,
    interim=False,
    columns=BATCH_ARR_FINAL_COLUMNS,
)


def first_order_dates(spans: DataFrame) -> DataFrame:
    """O15 (ARR table): min order date per (slice, customer)."""
    return spans.select("for_product", "customer_id", "_first_order_date").distinct()


def _row() -> list[Column]:
    """Which of a month's rows: order id, then the row's content."""
    return [F.col("ordernumber").alias("o"), F.col("_h").alias("h")]


def _reduced(om: DataFrame, key: list[str], same: list[str] = ()) -> DataFrame:
    """Month facts of order-month rows by `key`; columns that are the `same`
    in all rows of a key are kept."""
    return om.groupBy(*key).agg(
        F.sum("_arr_u").alias("_sum_u"),
        F.min(F.when(F.col("_arr_u") > 0, F.struct(F.col("_arr_u").alias("a"), *_row()))).alias("_tail"),
        F.min(F.struct(*_row())).alias("_min_on"),
        F.max(F.col("ordernumber").isNull()).alias("_null_on"),
        *[F.max(c).alias(c) for c in same],
    )


def customer_company_months(om: DataFrame, parts: int) -> DataFrame:
    """Order-month rows of customers reduced to (slice, customer, company,
    month), partitioned by `staging.LIE` into `parts`, under `_salt` 0.

    `_sum_u`: ARR (micro-units); `_tail`: (arr, order id, row) of the smallest
    paying row, the one a synthetic churn row copies; `_min_on` /
    `_null_on`: first order row of the month. A customer's orders lie in one
    task, so nothing is moved; a hot customer's months are reduced where its
    orders lie and then over its parts, so its volume never meets in one task.
    """
    om = om.filter(F.col("pivot_month").isNotNull() & F.col("customer_id").isNotNull())
    key = [*LIE, "company", "pivot_month"]
    merged = _reduced(om.filter("_hot"), key).groupBy(*K4).agg(
        F.sum("_sum_u").alias("_sum_u"), F.min("_tail").alias("_tail"), F.min("_min_on").alias("_min_on"), F.max("_null_on").alias("_null_on"),
        F.min(F.lit(0).cast("long")).alias("_salt"),  # a column, which a partitioning can name
    )
    return _reduced(om.filter("NOT _hot"), key).unionByName(merged.repartition(parts, *LIE))


#: A month with orders, or a synthetic churn month, of a customer's company.
FACT = ["m", "label", "delta", "h", "u", "syn"]


def _run(**known: Column) -> Column:
    """A run of `run` months from `m` on in which the same orders are active:
    what `FACT` says of its first month, and `later` of the months after it."""
    none = F.lit(None).cast("long")
    columns = {c: none for c in FACT} | {"run": F.lit(1), "later": F.lit(None).cast("string"), "later_delta": none, "later_h": none}
    return F.struct(*[c.alias(n) for n, c in (columns | {"syn": F.lit(False)} | known).items()])


def customer_facts(labelled: DataFrame, variant: Variant, by_runs: bool = False) -> DataFrame:
    """O23-O26 facts: one row per (slice, customer, company) with its months,
    from `rollforward.labelled_months` and all on its partitioning and sort.

    `_facts`: the months with orders, in order (`_months`: their month-ends);
    `_syn`: its synthetic churn months (O24), each with the hash `h` of the
    order row it copies; `_churn_date`: the customer's last month. With
    `by_runs` as `all_customer_runs`, each month a run of its own.
    """
    key = LIE  # `_salt` is 0
    churned = truthy(variant.churn_match(F.col("_label")))
    tail = _paying_tail(churned)
    # the companies of a customer's month are peers in a window; its first row stands for them
    w = Window.partitionBy(*key).orderBy("pivot_month")
    of_month = w.rangeBetween(Window.currentRow, Window.currentRow)
    months = (
        labelled.filter(F.col("_sum_u").isNotNull() & F.col("customer_id").isNotNull())
        .select(
            *key,
            "pivot_month",
            "_first_order_date",
            F.lag("pivot_month").over(w).alias("_before"),
            F.sum(F.when(churned, F.lit(0)).otherwise(F.col("_sum_u"))).over(of_month).alias("_cum_u"),
            F.min(tail).over(of_month).alias("_tail"),
            F.min("_min_on").over(of_month).alias("_min_on"),
            F.max("_null_on").over(of_month).alias("_null_on"),
            F.collect_list(F.struct(F.col("company").alias("c"), F.col("_label").alias("label"))).over(of_month).alias("_cos"),
        )
        .filter("_before IS NULL OR _before <> pivot_month")
        .drop("_before")
    )
    return _month_facts(months, by_runs)


def _paying_tail(churned: Column) -> Column:
    """A company's `_tail` with the company in it, unless its month is churned."""
    return F.when(
        ~churned & F.col("_tail.a").isNotNull(),
        F.struct(F.col("_tail.a").alias("a"), F.col("_tail.o").alias("o"), F.col("company").alias("c"), F.col("_tail.h").alias("h")),
    )


#: `staging.LIE` with what tells rows apart first: a sort compares less.
BY = ["customer_id", "for_product", "_salt"]


def order_runs(orders: DataFrame, bounds: SpineBounds) -> DataFrame:
    """Orders with months, once for each run of months they are active in; a
    customer's runs are cut wherever one of its orders begins or ends, so the
    same orders are active in all months of a run. `_at`: the run's first month
    in the spine (from 0), `_run`: its months."""
    at, to = F.col("_at"), F.col("_to")
    of_customer = Window.partitionBy(*LIE)
    o = orders.filter("_n_months > 0").withColumn("_at", bounds.place(F.col("_first_month")))
    o = o.withColumn("_to", at + F.col("_n_months"))
    o = o.withColumns({"_ats": F.collect_set(at).over(of_customer), "_tos": F.collect_set(to).over(of_customer)})
    o = o.withColumn("_cuts", bounds.cuts(F.sort_array(F.array_union("_ats", "_tos"))))
    o = o.withColumns({"_lo": F.array_position("_cuts", at).cast("int"), "_hi": F.array_position("_cuts", to).cast("int")})
    n = F.col("_hi") - F.col("_lo")
    runs = F.arrays_zip(F.slice("_cuts", F.col("_lo"), n).alias("at"), F.slice("_cuts", F.col("_lo") + 1, n).alias("to"))
    o = o.drop("_ats", "_tos").withColumn("_r", F.explode(runs))
    return o.withColumns({"_at": F.col("_r.at"), "_run": F.col("_r.to") - F.col("_r.at")}).drop("_r", "_cuts", "_lo", "_hi", "_to")


def lone_company_facts(orders: DataFrame, lone: DataFrame, bounds: SpineBounds, variant: Variant) -> DataFrame:
    """`all_customer_runs` of customers with one company each, whose orders lie
    in one part. `lone`: their spans, partitioned by `staging.LIE`.

    The row before a month is that of the same company in the month before, so
    the span's months without orders are not needed; and from a run's second
    month on nothing changes, so a run is one row (`order_runs`), reduced in the
    order that the windows want, on one sort."""
    of = {c: f"_of_{c}" for c in LIE}
    span = lone.select(*[F.col(c).alias(of[c]) for c in LIE], *SPAN)
    same = [orders[c] == span[of[c]] for c in LIE]
    mine = orders.select(*LIE, "company", "ordernumber", "_h", "_cost_u", "_first_month", "_n_months")
    # within its months an order pays
    om = order_runs(mine.join(span, same).drop(*of.values()), bounds).withColumnRenamed("_cost_u", "_arr_u")
    runs = _reduced(om, [*BY, "_at", "company"], [*SPAN, "_run"])
    nth = lambda k: F.last_day(F.element_at(bounds.months, k))  # noqa: E731  (from 1)
    w = Window.partitionBy(*BY).orderBy("_at")
    runs = runs.withColumns(
        {
            "pivot_month": nth(F.col("_at") + 1),
            "_last": nth(F.col("_at") + F.col("_run")),
            "_arr_u": F.when(F.col("company").isNotNull(), F.col("_sum_u")),
        }
    )
    runs = runs.withColumns({"_to": F.lag(F.col("_at") + F.col("_run")).over(w), "_before_u": F.lag("_arr_u").over(w)})
    runs = with_label(runs.withColumn("_prev_u", F.when(F.col("_to") == F.col("_at"), F.col("_before_u"))))
    # the second month's label, and each one's after it: the ARR before is the ARR
    later = classify(F.col("_arr_u"), F.col("_arr_u"), F.lit(0), F.lit(None).cast("date"), F.col("client_end_date"))
    churned = truthy(variant.churn_match(F.col("_label")))
    free = churned & (F.col("_run") == 1)  # of the last month: only a run's first can be a churn
    runs = runs.withColumns(
        {
            "_cum_u": F.when(churned, F.lit(0)).otherwise(F.col("_sum_u")),
            "_pays": ~churned & F.col("_tail").isNotNull(),
            "_last_u": F.when(free, F.lit(0)).otherwise(F.col("_sum_u")),
            "_last_tail": F.when(~free, F.struct(F.col("_tail.o").alias("o"), F.col("_tail.h").alias("h"), F.col("_tail").isNotNull().alias("pays"))),
        }
    )
    runs = runs.withColumns(
        {
            "_b": F.lag(F.struct("_last", "_last_u", "_last_tail")).over(w),
            "_next": F.lead(F.struct("pivot_month", "_pays")).over(w),
            "_through": F.sum("_run").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"),
        }
    )
    # as in `_month_facts`; the months of a run follow each other, and if one pays the later ones do
    late = next_month_end(F.col("_last"))
    last_pays = truthy(F.col("_last_tail.pays"))
    before_pays = truthy(F.col("_b._last_tail.pays"))
    joins = truthy(F.col("pivot_month") == next_month_end(F.col("_b._last")))
    met = before_pays & joins & ~F.col("_pays")
    broken = before_pays & ~joins
    copied = F.struct(F.col("_b._last_tail.o").alias("o"), F.col("_b._last_tail.h").alias("h"))
    first = F.when(met, F.least(F.col("_min_on"), copied)).otherwise(F.col("_min_on"))
    null_on = F.col("_null_on") | (met & F.col("_b._last_tail.o").isNull())
    gap = last_pays & ~(truthy(F.col("_next.pivot_month") == late) & truthy(F.col("_next._pays")))
    run = _run(
        m=F.col("pivot_month"), run=F.col("_run"), label=F.col("_label"), later=later,
        delta=F.col("_cum_u") - F.when(broken, F.lit(0)).otherwise(F.coalesce(F.col("_b._last_u"), F.lit(0))),
        later_delta=F.col("_sum_u") - F.coalesce("_sum_u", F.lit(0)),
        h=F.when(~null_on, first["h"]), later_h=F.when(~F.col("_null_on"), F.col("_min_on.h")),
    )
    churn = _run(m=late, label=F.lit("Churn"), h=F.col("_last_tail.h"), u=-F.col("_last_u"), syn=F.lit(True))
    each = {"_x": run, "_c": F.when(gap, churn), "_ends": F.when(last_pays, late).otherwise(F.col("_last"))}
    facts = runs.withColumns(each).groupBy(*BY, "company").agg(
        F.max("_first_order_date").alias("_first_order_date"), F.max("_ends").alias("_churn_date"),
        F.sort_array(F.collect_list("_x")).alias("_facts"), F.collect_list("_c").alias("_syn"),
        F.sort_array(F.collect_list("_through")).alias("_through"),
    )
    return facts.withColumn("_months", F.col("_facts.m"))


def all_customer_facts(
    orders: DataFrame, spans: DataFrame, hot: DataFrame, slices: DataFrame, bounds: SpineBounds, parts: int,
    variant: Variant, first_dates: DataFrame | None = None,
) -> DataFrame:
    """`customer_facts` of every customer: `all_customer_runs` by months."""
    facts = all_customer_runs(orders, spans, hot, slices, bounds, parts, variant, first_dates)

    def months(x: Column) -> Column:
        rest = F.slice(F.sequence(F.lit(0), x["run"] - 1), 2, x["run"])
        return F.concat(F.array(fact(x)), F.transform(rest, lambda k: F.struct(*[c.alias(n) for n, c in _month_of(x, k).items()])))

    def fact(x: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in FACT])

    facts = facts.withColumns({"_facts": F.flatten(F.transform("_facts", months)), "_syn": F.transform("_syn", fact)})
    return facts.withColumn("_months", F.col("_facts.m")).drop("_through")


def _month_of(run: Column, k: Column) -> dict[str, Column]:
    """What `FACT` says of a run's month `k` (from 0); a run has no month missing."""
    at_first = lambda c, later: F.when(k == 0, run[c]).otherwise(later)
    return {
        "m": at_first("m", F.last_day(F.add_months(run["m"], k))),
        "label": at_first("label", run["later"]),
        "delta": at_first("delta", run["later_delta"]),
        "h": at_first("h", run["later_h"]),
        "u": run["u"],
        "syn": run["syn"],
    }


def all_customer_runs(
    orders: DataFrame, spans: DataFrame, hot: DataFrame, slices: DataFrame, bounds: SpineBounds, parts: int,
    variant: Variant, first_dates: DataFrame | None = None,
) -> DataFrame:
    """The facts of every customer by runs of months (`_run`): of customers with
    one company, and of the others and the `hot` ones by all months of their
    spans. `_facts`, `_syn`: as in `customer_facts`; `_months`: the first
    month-end of each run; `_through`: how many months there are up to its last.
    An order's months are whole runs. All arguments as in
    `rollforward.labelled_months`; the orders lie by `staging.LIE`."""
    spans = spans.filter(F.col("customer_id").isNotNull())
    is_hot = (spans["for_product"] == hot["for_product"]) & (spans["customer_id"] == hot["customer_id"])
    lone = with_first_date(spans.filter("_companies = 1").join(hot, is_hot, "left_anti"), first_dates)
    # 0, but a column: a constant is no key of a join, and orders that lie by three keys are moved for one by two
    lone = lone.withColumn("_salt", F.col("_companies") - 1).repartition(parts, *LIE)
    apart = lone.select(*[F.col(c).alias(f"_of_{c}") for c in LIE])
    rest_orders = orders.join(apart, [orders[c] == apart[f"_of_{c}"] for c in LIE], "left_anti")
    of_rest = spans.filter("_companies > 1").unionByName(spans.filter("_companies = 1").join(hot, is_hot, "left_semi"))
    ccm = customer_company_months(arr_by_month(rest_orders, bounds, keep_monthless=False), parts)
    rest = customer_facts(labelled_months(of_rest, ccm, slices, bounds, parts, first_dates), variant, by_runs=True)
    return lone_company_facts(orders, lone, bounds, variant).unionByName(rest)


def _month_facts(months: DataFrame, by_runs: bool) -> DataFrame:
    """`customer_facts` from its rows per customer and month, which lie and
    are sorted as the window wants them."""
    key = LIE
    w = Window.partitionBy(*key).orderBy("pivot_month")
    # A churn month after every paying month that the next month does not follow paying.
    # Where the next month has (unpaying) orders it is that month, else a month of its own.
    late = lambda m: next_month_end(F.col(m))
    pays = F.col("_tail").isNotNull()
    months = months.withColumns(
        {
            "_b": F.lag(F.struct("pivot_month", "_cum_u", "_tail")).over(w),
            "_next": F.lead(F.struct("pivot_month", pays.alias("pays"))).over(w),
            # a month that pays is followed by that month or a later one, so only the last one's counts
            "_churn_date": F.max(F.when(pays, late("pivot_month")).otherwise(F.col("pivot_month"))).over(
                w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            ),
        }
    )
    follows = truthy(F.col("_next.pivot_month") == late("pivot_month"))
    months = months.withColumn("_gap", pays & ~(follows & truthy(F.col("_next.pays"))))
    joins = truthy(F.col("pivot_month") == late("_b.pivot_month"))  # the month before is the one before in the calendar
    before_pays = F.col("_b._tail").isNotNull()
    met = before_pays & joins & ~pays  # its churn is of this month
    broken = before_pays & ~joins  # its churn is of a month in between
    copied = F.struct(F.col("_b._tail.o").alias("o"), F.col("_b._tail.h").alias("h"))
    first = F.when(met, F.least(F.col("_min_on"), copied)).otherwise(F.col("_min_on"))
    null_on = F.col("_null_on") | (met & F.col("_b._tail.o").isNull())
    delta = F.col("_cum_u") - F.when(broken, F.lit(0)).otherwise(F.coalesce(F.col("_b._cum_u"), F.lit(0)))
    own = F.transform(
        "_cos",
        lambda x: F.struct(
            x["c"].alias("c"), F.col("pivot_month").alias("m"), x["label"].alias("label"), F.col("_delta_u").alias("delta"),
            F.col("_first_h").alias("h"), F.lit(None).cast("long").alias("u"), F.lit(False).alias("syn"),
        ),
    )
    churn = F.struct(
        F.col("_tail.c").alias("c"), late("pivot_month").alias("m"), F.lit("Churn").alias("label"), F.lit(None).cast("long").alias("delta"),
        F.col("_tail.h").alias("h"), (-F.col("_cum_u")).alias("u"), F.lit(True).alias("syn"),
    )
    months = months.withColumns({"_delta_u": delta, "_first_h": F.when(~null_on, first["h"])})
    facts = months.select(*key, "_first_order_date", "_churn_date", F.explode(F.when(F.col("_gap"), F.concat(own, F.array(churn))).otherwise(own)).alias("x"))
    known = {c: F.col(f"x.{c}") for c in FACT}
    all_of = F.collect_list(_run(**known) if by_runs else F.struct(*[c.alias(n) for n, c in known.items()]))
    facts = facts.groupBy(*key, F.col("x.c").alias("company")).agg(
        F.max("_first_order_date").alias("_first_order_date"), F.max("_churn_date").alias("_churn_date"), all_of.alias("_all")
    )
    facts = (
        facts.withColumn("_facts", F.sort_array(F.filter("_all", lambda x: ~x["syn"])))
        .withColumn("_syn", F.filter("_all", lambda x: x["syn"]))
        .withColumn("_months", F.col("_facts.m"))
        .drop("_all")
    )
    n = F.size("_facts")
    return facts.withColumn("_through", F.slice(F.sequence(F.lit(1), n + 1), 1, n)) if by_runs else facts


def _with_facts(df: DataFrame) -> DataFrame:
    names = {"m": "pivot_month", "label": "_label", "delta": "_delta_u", "h": "_first_on", "syn": "_syn"}
    fact = _month_of(F.col("_f"), F.col("_k"))
    return df.withColumns({name: fact[c] for c, name in names.items()})


def arr_rows(
    orders: DataFrame, facts: DataFrame, spans: DataFrame, hot: DataFrame, bounds: SpineBounds, parts: int,
    variant: Variant = PROCEDURE,
) -> DataFrame:
    """O23-O27 for every slice at once, from `all_customer_runs` of the same
    orders: order-month rows, and synthetic churn rows (`_syn`). Both sides
    carry the `MEET` columns (`staging.lay_orders`, `staging.lay_facts`) and
    lie by customer, so neither is moved; of a customer's companies each order
    takes its own. Nor are orders without months moved, to which the first order
    dates go.

    An order's months are a slice of its customer's: every month it is active
    in has an order, so none is missing between its first and its last, and it
    begins and ends with a run."""
    mine = [F.col(c).alias(f"_of_{c}") for c in (*LIE, "_company_key")]
    f = facts.select(*mine, "_first_order_date", "_churn_date", "_facts", "_months", "_through", F.col("_syn").alias("_churns"))
    # the company is no key of the join: neither side is partitioned by it
    same = F.array_contains(F.array("_of__company_key"), F.col("_company_key"))
    for c in LIE:
        same = (F.col(f"_of_{c}") == F.col(c)) & same
    # an order with a customer finds each of its months among the facts
    joined = orders.join(f, same).drop(*[f"_of_{c}" for c in (*LIE, "_company_key")])
    at = F.array_position("_months", F.col("_first_month")).cast("int")
    before = F.get("_through", at - 1) - F.get("_facts", at - 1)["run"]
    to = F.array_position("_through", before + F.col("_n_months")).cast("int")
    none = F.slice("_facts", 1, 0)
    own = F.when(F.col("_n_months") > 0, F.slice("_facts", at, to - at + 1)).otherwise(none)
    # an order that is copied sees all churn months and keeps its own: Spark compiles that, unlike a filter within the array
    copied = truthy((F.col("_copy") == 0) & F.array_contains(F.col("_churns.h"), F.col("_h")))
    taken = F.concat(own, F.when(copied, F.col("_churns")).otherwise(none))
    wide = joined.withColumn("_f", F.explode(taken)).drop("_facts", "_months", "_through", "_churns")
    wide = wide.filter(~F.col("_f.syn") | (F.col("_f.h") == F.col("_h")))
    wide = wide.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_f.run") - 1)))
    zero = F.lit(0).cast("long")
    free = F.col("_syn") | truthy(variant.churn_match(F.col("_label")))
    # within its months an order pays; the month it ends in is not one of them
    rows = _with_facts(wide).withColumns(
        {
            "_arr_u": F.when(free, zero).otherwise(F.col("_cost_u")),
            "_churn_u": F.when(F.col("_syn"), F.col("_f.u")).otherwise(zero),
        }
    ).drop("_f", "_k")
    # Orders without a customer have months but no facts; those of the batch generation without months stay, too.
    none = {c: F.lit(None).cast(t) for c, t in (("_label", "string"), ("_delta_u", "long"), ("_first_on", "long"), ("_churn_date", "date"))}
    none |= {"_churn_u": zero, "_syn": F.lit(False)}
    months = active_month_starts("standardstartdate", "standardenddate_adjusted", bounds)
    nobody = orders.filter(F.col("customer_id").isNull()).select("*", F.explode(months).alias("_ms"))
    nobody = nobody.withColumns(
        none | {"pivot_month": F.last_day("_ms"), "_arr_u": F.col("_cost_u"), "_first_order_date": F.lit(None).cast("date")}
    ).drop("_ms")
    rows = rows.unionByName(nobody)
    if variant.keep_monthless:
        lone = orders.filter("_n_months = 0").join(lay_dates(first_order_dates(spans), hot, parts), LIE, "left")
        rows = rows.unionByName(lone.withColumns(none | {"pivot_month": F.lit(None).cast("date"), "_arr_u": zero}))
    return _finish(rows, variant)


def _finish(df: DataFrame, variant: Variant) -> DataFrame:
    """Row-level O25 split, O26 interim churn and the output columns."""
    label = F.col("_label")
    ok = F.col("customer_id").isNotNull() & F.col("ordernumber").isNotNull() & F.col("pivot_month").isNotNull()
    first = (F.col("_copy") == 0) & ~F.col("_syn") & truthy(F.col("_h") == F.col("_first_on"))
    zero = F.lit(0).cast("long")

    def split(name: str) -> Column:
        return F.when(ok, F.when(truthy(label == name) & first, F.col("_delta_u")).otherwise(zero))

    def share(name: str) -> Column:
        return F.when(ok, F.when(truthy(label == name), F.col("_arr_u")).otherwise(zero))

    df = df.withColumns(
        {
            "_up_u": split("Upgrade"),
            "_down_u": split("Downgrade"),
            "_new_u": share("New"),
            "_react_u": share("Reactivation"),
        }
    )
    if variant.interim:
        interim = truthy((F.trim(label) == "Churn") & (F.col("pivot_month") < F.last_day("_churn_date")))
        df = df.withColumns(
            {
                "_interim_u": F.when(interim, F.col("_churn_u")).otherwise(zero),
                "_churn_u": F.when(interim, zero).otherwise(F.col("_churn_u")),
                "_label_out": F.when(interim, F.lit("Interim Churn")).otherwise(label),
            }
        )
    else:
        df = df.withColumns({"_interim_u": zero, "_label_out": label})
    out = {
        "arr_currency": from_micros(F.col("_arr_u")),
        "churn_arr_currency": from_micros(F.col("_churn_u")),
        "customer_classification": F.col("_label_out"),
        "upgrade_currency": from_micros(F.col("_up_u")),
        "downgrade_currency": from_micros(F.col("_down_u")),
        "new_currency": from_micros(F.col("_new_u")),
        "reactivation_currency": from_micros(F.col("_react_u")),
        "interim_churn_arr_currency": from_micros(F.col("_interim_u")),
        "first_order_date": F.col("_first_order_date"),
    }
    keep_internal = ["_label", "_arr_u", "_churn_u", "_interim_u", "_cost_u", "_syn"]
    cols = [out[c].alias(c) if c in out else F.col(c) for c in variant.columns]
    return df.select(*cols, *[F.col(c) for c in keep_internal])


def public(df: DataFrame, variant: Variant = PROCEDURE) -> DataFrame:
    return df.select(*variant.columns)
