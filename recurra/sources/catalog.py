"""Published tables by name: readers use `database.table`, whatever run it is of.

Every run writes its tables under names of their own (`arr_final__r17…`), all
of them before any reader can see one. Then the views that readers use are
switched, each by one CREATE OR REPLACE VIEW, which the catalog does at once. A
run that fails while it writes is dropped and no view has changed; one that
fails while it switches puts the views already switched back first. Tables of
a run never change, so a reader that wants several tables of one run takes
them through `snapshot`.

Runs that no view names stay until `expire` drops them by age, those that a
lost driver left half written too.
"""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

RUN_PROPERTY = "recurra.run"
RUN_TABLE = re.compile(r".+__(r\d{13}_[0-9a-f]{8})")


def new_run(now: float | None = None) -> str:
    """A name that tells when the run began (milliseconds) and is its own."""
    return f"r{int((time.time() if now is None else now) * 1000):013d}_{uuid.uuid4().hex[:8]}"


def run_started(run: str) -> dt.datetime:
    return dt.datetime.fromtimestamp(int(run[1:].split("_")[0]) / 1000, dt.timezone.utc)


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


@dataclass
class TableStore:
    """The published tables of one database of the session's catalog."""

    spark: SparkSession
    database: str

    def _sql(self, text: str) -> DataFrame:
        return self.spark.sql(text)

    def _name(self, table: str) -> str:
        return _quoted(self.database, table)

    def _tables(self) -> list[str]:
        if not self.spark.catalog.databaseExists(self.database):
            return []
        return [r["tableName"] for r in self._sql(f"SHOW TABLES IN {_quoted(self.database)}").collect() if not r["isTemporary"]]

    def _of_run(self, run: str) -> list[str]:
        return [t for t in self._tables() if (m := RUN_TABLE.fullmatch(t)) and m[1] == run]

    def runs(self) -> list[str]:
        """Runs with tables, oldest first, whole or not."""
        return sorted({m[1] for t in self._tables() if (m := RUN_TABLE.fullmatch(t))})

    def published(self) -> dict[str, str]:
        """The name and run of every view that this store has published."""
        if not self.spark.catalog.databaseExists(self.database):
            return {}
        views = [r["viewName"] for r in self._sql(f"SHOW VIEWS IN {_quoted(self.database)}").collect() if not r["isTemporary"]]
        return {v: run for v in views if (run := self.current(v))}

    def current(self, table: str) -> str | None:
        """The run that readers of `table` get, if it is published."""
        if not self.spark.catalog.tableExists(f"{self._name(table)}"):
            return None
        rows = self._sql(f"SHOW TBLPROPERTIES {self._name(table)}").collect()
        return {r["key"]: r["value"] for r in rows}.get(RUN_PROPERTY)

    def _point(self, table: str, run: str, columns: Iterable[str]) -> None:
        cols = ", ".join(_quoted(c) for c in columns)
        self._sql(
            f"CREATE OR REPLACE VIEW {self._name(table)} TBLPROPERTIES ('{RUN_PROPERTY}' = '{run}') "
            f"AS SELECT {cols} FROM {self._name(f'{table}__{run}')}"
        )

    def _drop_run(self, run: str) -> None:
        for t in self._of_run(run):
            self._sql(f"DROP TABLE IF EXISTS {self._name(t)}")

    def publish(self, outputs: Mapping[str, DataFrame], partition_by: str | None = "for_product") -> str:
        """Write all `outputs` as the tables of a new run, then switch their
        views to it; returns the run."""
        run = new_run()
        self._sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(self.database)}")
        try:
            for table, df in outputs.items():
                w = df.write.format("parquet").mode("errorifexists")
                if partition_by in df.columns:
                    w = w.partitionBy(partition_by)
                w.saveAsTable(self._name(f"{table}__{run}"))
        except BaseException:
            self._drop_run(run)
            raise
        before = {t: (self.current(t), self.spark.table(self._name(t)).columns if self.current(t) else ()) for t in outputs}
        switched: list[str] = []
        try:
            for table, df in outputs.items():
                self._point(table, run, df.columns)
                switched.append(table)
        except BaseException:
            for table in switched:
                former, columns = before[table]
                if former is None:
                    self._sql(f"DROP VIEW IF EXISTS {self._name(table)}")
                else:
                    self._point(table, former, columns)
            self._drop_run(run)
            raise
        return run

    def snapshot(self, tables: Iterable[str]) -> dict[str, DataFrame]:
        """Several tables of one and the same run, that of the first's view,
        even while another run is being switched to."""
        tables = list(tables)
        run = self.current(tables[0])
        if run is None:
            raise ValueError(f"{self.database}.{tables[0]} is not published")
        return {t: self.spark.table(self._name(f"{t}__{run}")) for t in tables}

    def expire(self, older_than: dt.timedelta, keep: int = 1, now: dt.datetime | None = None) -> list[str]:
        """Drop the runs that no view names, that began longer ago than
        `older_than` and are not among the `keep` latest; returns them. The age
        must exceed what a run, or a reader of one, takes."""
        now = now or dt.datetime.now(dt.timezone.utc)
        named = set(self.published().values())
        runs = self.runs()
        gone = [r for r in runs[: max(0, len(runs) - keep)] if r not in named and now - run_started(r) > older_than]
        for run in gone:
            self._drop_run(run)
        return gone
