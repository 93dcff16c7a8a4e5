"""The ARR table's rows from customer facts by runs of months: the same as from
a fact for every month, with generators that Spark compiles."""

from collections import Counter

from pyspark.sql import functions as F

from recurra.operators import arr, staging
from tests.test_hot_customer import no_broadcast, plan_of  # noqa: F401
from tests.test_lone_company import pipe  # noqa: F401
from tests.test_one_exchange import moves
from tests.test_runs import pipe as whole_calendar  # noqa: F401


def test_rows_are_those_of_single_months(pipe):  # noqa: F811
    each = arr.customer_facts(pipe.labelled, arr.PROCEDURE, by_runs=True)
    laid = staging.lay_facts(each, pipe.hot, pipe.parts)
    want = arr.public(arr.arr_rows(pipe.orders, laid, pipe.spans, pipe.hot, pipe.bounds, pipe.parts))
    want, got = (Counter(map(repr, df.collect())) for df in (want, pipe.arr_final))
    assert got == want and sum(want.values()) > 1000


def test_rows_are_made_by_compiled_code(whole_calendar):  # noqa: F811
    # functions of array elements are interpreted, and the generator above them with its copy of each row
    assert "lambda" not in plan_of(whole_calendar.arr_final)


def test_runs_are_fewer_than_months(whole_calendar):  # noqa: F811
    p = whole_calendar
    facts = arr.all_customer_runs(p.orders, p.spans, p.hot, p.slices, p.bounds, p.parts, arr.PROCEDURE)
    last = F.get("_through", F.size("_through") - 1)
    runs, months = facts.agg(F.sum(F.size("_facts")), F.sum(last)).first()
    assert 2 * runs < months


def test_orders_are_not_moved_for_the_facts(whole_calendar, no_broadcast):  # noqa: F811
    p = whole_calendar
    facts = arr.all_customer_runs(p.orders, p.spans, p.hot, p.slices, p.bounds, p.parts, arr.PROCEDURE)
    # the third scan is that of the hot customers' orders
    assert sorted(moves(plan_of(facts), "recurra_orders")) == [False, False, True]
