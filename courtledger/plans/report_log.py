"""What the loads of every run counted and audited, kept beside the tables."""

from __future__ import annotations

from datetime import datetime
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtledger.session import stored

if TYPE_CHECKING:
    from courtledger.plans.pipeline import LoadReport

_COUNTS = "run string, loaded_at timestamp, load string, stage string, n bigint"


class ReportLog:
    """Counts by stage, and all rows of every audit, of the runs over one warehouse.

    The counts of a run are written last: a run without them did not finish, and its audits
    are not shown.
    """

    def __init__(self, spark: SparkSession, warehouse_path: str):
        self.spark = spark
        self.path = f"{warehouse_path.rstrip('/')}/_reports"

    def record(self, run: str, loaded_at: datetime, reports: dict[str, LoadReport]) -> None:
        counts = []
        for load, report in reports.items():
            stages = {**report.rows, **report.steps}
            for name, audit in report.audits.items():
                kept = stored(audit, f"audit-{name}")
                stages[f"audit: {name}"] = kept.count()
                # Each kind of audit has columns of its own, and so a folder of its own.
                kept.write.mode("append").parquet(f"{self.path}/{load}.{name}/run={run}")
            counts += [(run, loaded_at, load, stage, n) for stage, n in stages.items()]
        self.spark.createDataFrame(counts, _COUNTS).coalesce(1).write.mode("append").parquet(
            f"{self.path}/counts"
        )

    def counts(self) -> DataFrame:
        """``run, loaded_at, load, stage, n`` of all finished runs."""
        try:
            return self.spark.read.schema(_COUNTS).parquet(f"{self.path}/counts")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COUNTS)

    def audit(self, load: str, name: str) -> DataFrame:
        """The rows an audit found, with the ``run`` that found them."""
        rows = self.spark.read.option("mergeSchema", True).parquet(f"{self.path}/{load}.{name}")
        # Partition values are read as what they look like.
        named = rows.withColumn("run", F.col("run").cast("string"))
        return named.join(self.counts().select("run").distinct(), "run", "left_semi")
