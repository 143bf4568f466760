"""Tables by name: runs registered in the session's catalog, one pointer to the
published run, and single tables overwritten in one step.

* Every run is a database of its own (`<store>_run_<id>`), whose tables lie where
  the run wrote them. Nothing in it changes after it has been registered.
* `<store>.published` is a view of one row that names the published run. It is
  replaced by one catalog statement, the only step of publishing that readers can
  see. `current` reads it once and gives a `Run`, so all tables that a reader
  takes from it are of one run, whatever is published meanwhile.
* `overwrite` is `create or replace table` from a query: the rows are written to a
  new folder, registered under a name of their own, and the view `<database>.<name>`
  is turned to it in one step. Readers that began before still read the old folder;
  a query that fails leaves the table as it was.

Folders go where the caller says, else under the session's checkpoint folder.
Old runs and old versions are the store's to expire: `expire` drops all but the
newest runs from the catalog (the files of external tables stay). The catalog is
that of the session; with a metastore the names outlive it.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ensure_checkpoint_dir

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


def _checked(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"not a plain name: {name!r}")
    return name


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_name(path_name: str) -> str:
    """Name of a run's table: `raw/plans` is `raw_plans`."""
    return _checked(re.sub(r"\W", "_", path_name))


@dataclass(frozen=True)
class Run:
    """One registered run."""
    spark: SparkSession
    database: str
    run_id: str

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{table_name(name)}")

    def tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary)

    def use(self) -> None:
        """Make it the current database: plain names, also in SQL, are its tables."""
        self.spark.catalog.setCurrentDatabase(self.database)


class TableStore:
    def __init__(self, spark: SparkSession, name: str = "tidemark", location: str | None = None):
        self.spark, self.name = spark, _checked(name)
        self.location = (location or f"{ensure_checkpoint_dir(spark)}/tidemark-tables").rstrip("/")

    def _database(self, name: str) -> str:
        """Its comment is when it was made."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {_text(str(time.time_ns()))} "
                       f"LOCATION {_text(f'{self.location}/{name}.db')}")
        return name

    def _create(self, full_name: str, path: str) -> None:
        self.spark.catalog.createTable(full_name, path=path, source="parquet")
        if any(c.isPartition for c in self.spark.catalog.listColumns(full_name)):
            self.spark.catalog.recoverPartitions(full_name)  # the catalog lists them itself

    def register(self, run_id: str, paths: dict[str, str]) -> Run:
        """Register the Parquet tables of a run; readers do not see it yet."""
        database = self._database(f"{self.name}_run_{re.sub(r'[^A-Za-z0-9]', '_', run_id)}")
        for name, path in paths.items():
            self._create(f"{database}.{table_name(name)}", path)
        return Run(self.spark, database, run_id)

    def publish(self, run: Run) -> None:
        """Turn all readers to `run`, in one step."""
        self._database(self.name)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name}.published AS SELECT "
                       f"{_text(run.database)} AS run_database, {_text(run.run_id)} AS run_id, "
                       f"{_text(uuid.uuid4().hex)} AS publication")

    def current(self) -> Run:
        row = self.spark.table(f"{self.name}.published").first()
        return Run(self.spark, row.run_database, row.run_id)

    def expire(self, keep: int = 3) -> list[str]:
        """Drop the databases of all but the `keep` runs registered last; the
        published one always stays. Returns what was dropped, oldest first."""
        published = self.current().database
        runs = sorted((d for d in self.spark.catalog.listDatabases(f"{self.name}_run_*")),
                      key=lambda d: int(d.description))
        old = [d.name for d in runs if d.name != published][:max(0, len(runs) - keep)]
        for database in old:
            self.spark.sql(f"DROP DATABASE {database} CASCADE")
        return old

    def overwrite(self, name: str, df: DataFrame, database: str | None = None) -> DataFrame:
        """`create or replace table <database>.<name> as <df>`; df may read the
        table that it replaces."""
        database = self._database(_checked(database or self.name))
        version = f"{_checked(name)}__{uuid.uuid4().hex}"
        path = f"{self.location}/{database}/{name}/{version}"
        df.write.parquet(path)
        self._create(f"{database}.{version}", path)
        self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {database}.{version}")
        return self.spark.table(f"{database}.{name}")
