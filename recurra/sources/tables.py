"""Input tables of the pipeline and a reader for a directory of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT, TIME, DAY, NUMBER = "text", "time", "day", "number"


def _texts(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, TEXT)


# Columns each input must provide, and of which kind (FIXTURES.md section 1).
COLUMNS: dict[str, dict[str, str]] = {
    "transactions_raw": _texts("id", "currentbillingentityid")
    | {"DATE": TIME, "periodstart": TIME, "periodend": TIME, "originalamount": NUMBER}
    | _texts("originalcurrencycode", "objectid", "objecttypeid", "objectaccesstype", "type", "source", "connectedto"),
    "company_raw": _texts("id", "name", "classification", "countrycode", "state", "city"),
    "product_dim": _texts("objecttypeid", "product"),
    "price_grid": _texts("currency_code", "product", "objectaccesstype") | dict.fromkeys(("price_th1", "price_th2", "price_th3"), NUMBER),
    "legacy_licenses": _texts("licenseid"),
    "calendar": {"ds": DAY},
    "region_dim": _texts("country_code", "country"),
    "classified_transactions": _texts("id", "currentbillingentityid")
    | {"DATE": TIME, "transactionarr": NUMBER}
    | _texts("termlength", "customername", "objecttypeid", "type", "matchingrefund"),
    "company": _texts("id", "classification", "countrycode", "state", "city"),
}
OPTIONAL = ("classified_transactions", "company")  # the batch generation's
TRANSACTION_COLUMNS = tuple(COLUMNS["transactions_raw"])

#: Spark types that hold a kind, and the type a column of that kind gets.
_HOLDS = {
    TEXT: (T.StringType, T.CharType, T.VarcharType, T.IntegralType),
    TIME: (T.TimestampType, T.TimestampNTZType, T.DateType),
    DAY: (T.DateType, T.TimestampType, T.TimestampNTZType),
    NUMBER: (T.NumericType,),
}


class InputError(ValueError):
    """An input table that cannot be used, with everything that is wrong."""


@dataclass
class Inputs:
    """All source tables. Timestamps are wall-clock TIMESTAMP_NTZ."""

    transactions: DataFrame
    company: DataFrame
    product_dim: DataFrame
    price_grid: DataFrame
    legacy_licenses: DataFrame
    calendar: DataFrame
    region_dim: DataFrame
    classified: DataFrame | None = None
    batch_company: DataFrame | None = None


def _wall_clock(name: str, kind: T.DataType) -> Column:
    """Instants become UTC wall-clock times, whatever the session's time zone;
    columns that are wall-clock already stay as they are."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(name), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.col(name).cast("timestamp_ntz")


def conform(df: DataFrame, table: str) -> DataFrame:
    """The columns that `table` must have, in their types, and no others.
    Names are compared as Spark compares them, without regard to case. All that
    is missing or of another kind is told at once."""
    have: dict[str, list[T.StructField]] = {}
    for f in df.schema.fields:
        have.setdefault(f.name.lower(), []).append(f)
    wrong, cols = [], []
    for name, kind in COLUMNS[table].items():
        found = have.get(name.lower(), [])
        if len(found) != 1:
            wrong.append(f"no column {name}" if not found else f"column {name} stands {len(found)} times")
            continue
        field, own = found[0], f"`{found[0].name}`"
        if not isinstance(field.dataType, _HOLDS[kind]):
            wrong.append(f"column {name} is {field.dataType.simpleString()}, not a {kind}")
        elif kind == TIME:
            cols.append(_wall_clock(own, field.dataType).alias(name))
        elif kind == DAY:
            cols.append(_wall_clock(own, field.dataType).cast("date").alias(name))
        else:
            cols.append(F.col(own).cast("string" if kind == TEXT else "double").alias(name))
    if wrong:
        raise InputError(f"{table}: {'; '.join(wrong)}")
    return df.select(*cols)


def _inputs(read: Callable[[str], DataFrame | None]) -> Inputs:
    """All inputs, each read and conformed; what is wrong with any of them is
    told at once."""
    got: dict[str, DataFrame | None] = {}
    wrong = []
    for table in COLUMNS:
        df = read(table)
        try:
            got[table] = None if df is None else conform(df, table)
        except InputError as e:
            wrong.append(str(e))
    if wrong:
        raise InputError("\n".join(wrong))
    return Inputs(
        transactions=got["transactions_raw"],
        company=got["company_raw"],
        product_dim=got["product_dim"],
        price_grid=got["price_grid"],
        legacy_licenses=got["legacy_licenses"],
        calendar=got["calendar"],
        region_dim=got["region_dim"],
        classified=got["classified_transactions"],
        batch_company=got["company"],
    )


def read_inputs(spark: SparkSession, base: str, fmt: str = "parquet") -> Inputs:
    """Read `<base>/<table>` for each input table (production layout).

    The batch generation's tables (`classified_transactions`, `company`) are
    optional; any other failure to read is an error.
    """

    def read(table: str) -> DataFrame | None:
        try:
            return spark.read.format(fmt).load(f"{base}/{table}")
        except AnalysisException as e:
            if table not in OPTIONAL or e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    return _inputs(read)


def read_catalog(spark: SparkSession, database: str, names: Mapping[str, str] | None = None) -> Inputs:
    """Read the input tables (or views) from the session's catalog:
    `<database>.<table>`, or the full name that `names` gives for a table. The
    batch generation's are optional; others that are not there are named, all
    of them, in an `InputError`."""
    names = {t: f"{database}.{t}" for t in COLUMNS} | dict(names or {})
    if unknown := set(names) - set(COLUMNS):
        raise InputError(f"no such input: {', '.join(sorted(unknown))}")
    there = {t: spark.catalog.tableExists(n) for t, n in names.items()}
    if absent := [f"{t} ({names[t]})" for t in COLUMNS if not there[t] and t not in OPTIONAL]:
        raise InputError(f"no table for {', '.join(absent)}")
    return _inputs(lambda t: spark.table(names[t]) if there[t] else None)
