"""The record of runs: one row when a run starts and one when it ends."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayblotter.fixed_values import RUN_STATUSES
from dayblotter.functions.columns import conform
from dayblotter.operators.incremental import next_number
from dayblotter.schemas import RUNS
from dayblotter.session import path_exists


class RunLog:
    def __init__(self, spark: SparkSession, path: str, pipeline_name: str, config: dict) -> None:
        self.spark, self.path = spark, path
        self.pipeline_name, self.config = pipeline_name, config

    def read(self):
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], RUNS)
        return self.spark.read.schema(RUNS).parquet(self.path)

    def next_run_id(self) -> int:
        return next_number(self.read(), "run_id", "run_id").first()[0]

    def record(self, run_id: int, status: str, logs: str | None = None) -> None:
        if status not in RUN_STATUSES:
            raise ValueError(f"status is one of {RUN_STATUSES}")
        entry = self.spark.createDataFrame([(run_id, status, logs)], "run_id int, status string, logs string")
        self.record_all(entry)

    def record_all(self, entries: DataFrame) -> None:
        """Append records: run_id, status and, if there is any, logs."""
        kept = entries.withColumns(
            {
                "pipeline_name": F.lit(self.pipeline_name),
                "timestamp": F.current_timestamp(),
                "config": F.lit(json.dumps(self.config)),
            }
        )
        conform(kept, RUNS).write.mode("append").parquet(self.path)
