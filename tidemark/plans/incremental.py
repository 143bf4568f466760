"""The customer dimension kept up to date day by day.

The islands of each key's last version are the state: they alone can grow. A step
reads them and the new snapshot days, never the history, and writes two folders:
the new state, and the islands that no later day can change. A step is committed by
one row appended to `_steps`; a step that breaks leaves folders that no row names.

A row on or before its key's last day comes late. The versions of such keys are built
again from all their snapshots; the islands kept of them before are left out by
readers, who find the keys in the step's `rebuilt` folder.

`islands` gives what `snapshot_versions` gives over all days so far, `dimension`
what the full chain gives. Rules are the default ones (not `null_safe`).
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.scd import (
    IDENTITY, WIDE, close_ranges, late_keys, merge_snapshots, record_identity, snapshot_versions)
from tidemark.plans.marts import CUSTOMER_CARRIED, CUSTOMER_TRACKED, SCD_COLUMNS
from tidemark.session import path_exists

KEY = "customer_id"
STEP_COLUMNS = ["number", "step", "rebuilt", "schema"]


class IncrementalDimension:
    """Its folder holds steps; `snapshots()` gives all snapshot rows that have been
    delivered, for keys with late rows."""

    def __init__(self, spark: SparkSession, folder: str, wide_rows: int | None = 10_000):
        self.spark, self.folder, self.wide_rows = spark, folder.rstrip("/"), wide_rows
        self._steps = f"{self.folder}/_steps"

    def _committed(self) -> list:
        """(number, step, rebuilt, schema) of the steps, in order: one row per day or so."""
        if not path_exists(self.spark, self._steps):
            return []
        rows = self.spark.read.parquet(self._steps)
        return sorted(tuple(r) for r in rows.select(*STEP_COLUMNS).collect())

    def _write(self, number: int, step: str, islands: DataFrame, rebuilt: bool) -> tuple:
        """Open and kept islands in one pass, as partitions of one folder; the row in
        `_steps` is the last thing written."""
        islands.write.partitionBy("is_open").parquet(f"{self.folder}/{step}/islands")
        row = (number, step, rebuilt, islands.schema.json())
        self.spark.createDataFrame([row], "number long, step string, rebuilt boolean, schema string"
                                   ).coalesce(1).write.mode("append").parquet(self._steps)
        return row

    def _part(self, step: tuple, is_open: bool) -> DataFrame:
        # an empty folder tells no schema
        schema = T.StructType.fromJson(json.loads(step[3]))
        return (self.spark.read.schema(schema).parquet(f"{self.folder}/{step[1]}/islands")
                .where(F.col("is_open") == F.lit(is_open)).drop("is_open"))

    def _full(self, snapshots: DataFrame) -> DataFrame:
        return snapshot_versions(snapshots, KEY, CUSTOMER_TRACKED, CUSTOMER_CARRIED,
                                 wide_rows=self.wide_rows, keep_helpers=True).drop(WIDE)

    @staticmethod
    def _of_keys(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col(KEY).alias("_k"), F.col(IDENTITY).alias("_i"))
        return rows.join(keys, F.col(KEY).eqNullSafe(F.col("_k"))
                         & F.col(IDENTITY).eqNullSafe(F.col("_i")), how)

    def advance(self, new_days: DataFrame, snapshots: DataFrame) -> None:
        """Take in the snapshot rows of one or more days. `snapshots`: all rows
        delivered so far, these included; read only if a key has late rows."""
        steps, step = self._committed(), f"step-{uuid.uuid4().hex}"
        if not steps:
            opened = self._full(new_days.limit(0)).withColumn("is_open", F.lit(True))
            steps = [self._write(0, step, opened, False)]
            step = f"step-{uuid.uuid4().hex}"
        state = self._part(steps[-1], True)
        late = late_keys(state, new_days, KEY, CUSTOMER_TRACKED, CUSTOMER_CARRIED)
        late_path = f"{self.folder}/{step}/rebuilt"
        late.write.parquet(late_path)
        late = self.spark.read.parquet(late_path)
        rebuilt = not late.isEmpty()
        if rebuilt:
            with_identity = self._identified(new_days)
            on_time = self._of_keys(with_identity, late, "left_anti").drop(IDENTITY)
            merged = merge_snapshots(self._of_keys(state, late, "left_anti"), on_time, KEY,
                                     CUSTOMER_TRACKED, CUSTOMER_CARRIED)
            again = self._full(self._of_keys(self._identified(snapshots), late, "left_semi").drop(IDENTITY))
            last = again.groupBy(F.col(KEY).alias("_k2"), F.col(IDENTITY).alias("_i2")).agg(
                F.max("version_id").alias("_last"))
            again = again.join(last, F.col(KEY).eqNullSafe(F.col("_k2"))
                               & F.col(IDENTITY).eqNullSafe(F.col("_i2"))).withColumn(
                "is_open", F.col("version_id") == F.col("_last"))
            merged = merged.unionByName(again.select(*merged.columns))
        else:
            merged = merge_snapshots(state, new_days, KEY, CUSTOMER_TRACKED, CUSTOMER_CARRIED)
        self._write(steps[-1][0] + 1, step, merged, rebuilt)

    @staticmethod
    def _identified(snapshots: DataFrame) -> DataFrame:
        identity = [c for c in snapshots.columns if c in CUSTOMER_CARRIED]
        return snapshots.withColumn(IDENTITY, record_identity(KEY, identity))

    def islands(self) -> DataFrame:
        """All islands: the state, and what each step has kept."""
        steps = self._committed()
        parts = [self._part(steps[-1], True)]
        for place, step in enumerate(steps):
            kept = self._part(step, False)
            for _, later, rebuilt, _ in steps[place + 1:]:
                if rebuilt:
                    kept = self._of_keys(kept, self.spark.read.parquet(f"{self.folder}/{later}/rebuilt"),
                                         "left_anti")
            parts.append(kept.select(*parts[0].columns))
        return reduce(DataFrame.unionByName, parts)

    def dimension(self) -> DataFrame:
        """The closed ranges, as `int_customer_scd` over all days."""
        return close_ranges(self.islands(), KEY, identity=IDENTITY).select(*SCD_COLUMNS)
