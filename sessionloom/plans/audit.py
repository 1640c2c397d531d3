"""Audit rows: one per tenant, table and run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, types as T

# The audit schema.
AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("pipeline_run_ts", T.TimestampNTZType()),
    T.StructField("client_name", T.StringType()),
    T.StructField("source_table", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("stage_failed", T.StringType()),
    T.StructField("is_full_load", T.BooleanType()),
    T.StructField("rows_read_raw", T.LongType()),
    T.StructField("null_user_agent_dropped", T.LongType()),
    T.StructField("bots_dropped", T.LongType()),
    T.StructField("invalid_identity_dropped", T.LongType()),
    T.StructField("mongo_filter_leak_dropped", T.LongType()),
    T.StructField("orphans_dropped", T.LongType()),
    T.StructField("final_rows_written", T.LongType()),
    T.StructField("null_timestamp_dropped", T.LongType()),
    T.StructField("duplicate_mongo_id_dropped", T.LongType()),
])

COUNTERS = [f.name for f in AUDIT_SCHEMA.fields if isinstance(f.dataType, T.LongType)]
MESSAGE_CHARS = 500


@dataclass
class Audit:
    """Collects counters and failures while a run goes on."""

    run_id: str
    run_date: date
    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None))
    rows: dict[tuple[str, str], dict] = field(default_factory=dict)

    def open(self, tenant: str, table: str, full_load: bool) -> None:
        self.rows[tenant, table] = {
            "run_id": self.run_id, "run_date": self.run_date, "pipeline_run_ts": self.run_ts,
            "client_name": tenant, "source_table": table, "status": "STARTED",
            "error_message": None, "stage_failed": None, "is_full_load": full_load,
            **{c: 0 for c in COUNTERS},
        }

    def count(self, tenant: str, table: str, **counters: int) -> None:
        self.rows[tenant, table].update(counters)

    def fail(self, tenant: str, table: str, stage: str, error: Exception | str) -> None:
        self.rows[tenant, table].update(
            status="FAILED", stage_failed=stage, error_message=str(error)[:MESSAGE_CHARS]
        )

    def close(self, tenant: str, table: str, kept: int) -> None:
        row = self.rows[tenant, table]
        if row["status"] == "STARTED":
            row["status"] = "SUCCESS" if kept else "EMPTY"

    def frame(self, spark: SparkSession) -> DataFrame:
        data = [tuple(r[f.name] for f in AUDIT_SCHEMA.fields) for r in self.rows.values()]
        return spark.createDataFrame(data, AUDIT_SCHEMA)
