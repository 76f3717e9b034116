"""Catalog ingest: read, validate, transform, upsert, audit."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from skyops.operators import catalog, quality
from skyops.session import cut_lineage
from skyops.sinks import audit, upsert


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _start(run_id: str | None) -> dict:
    return {"run_id": run_id or str(uuid.uuid4()), "started_at": _now(), "status": "running",
            "records_extracted": 0, "records_validated": 0, "records_failed_validation": 0,
            "records_transformed": 0, "records_loaded": 0}


def routed_rows(raw: DataFrame, run: dict) -> DataFrame:
    """Validate once, keep the labelled rows on storage, and take the counts from that write."""
    seen = Observation()
    routed = cut_lineage(quality.route(raw).observe(seen, *quality.report_columns()))
    counts = seen.get
    run.update(records_extracted=counts["checked"], records_validated=counts["valid"],
               records_failed_validation=counts["failed"])
    return routed


def ingest(raw: DataFrame, table: str, runs_table: str, seq: int, *,
           dry_run: bool = False, run_id: str | None = None, now=None) -> dict:
    """Run all stages; a dry run stops before the table but is audited, as is a failure.

    ``raw`` holds the raw columns and a unique ``row_ord``; ``seq`` numbers the writes of the table. Returns the audit record.
    """
    spark = raw.sparkSession
    run = _start(run_id)
    try:
        routed = routed_rows(raw, run)
        clean = catalog.transform(routed.filter(F.col("outcome") == "valid"))
        run["records_transformed"] = run["records_validated"]
        if dry_run:
            run["status"] = "dry_run"
        else:
            if run["records_transformed"]:
                upsert.write_upsert(upsert.stamp(clean, run["run_id"], now), table, seq)
            run["records_loaded"] = run["records_transformed"]
            run["status"] = "success"
    except Exception as e:
        run.update(status="failed", error_message=str(e))
        raise
    finally:
        run["completed_at"] = _now()
        audit.append_run(spark, run, runs_table)
    return run


def validate_only(raw: DataFrame) -> tuple[dict, DataFrame]:
    """The first two stages, without an audit row: (run record, labelled rows)."""
    run = _start(None)
    routed = routed_rows(raw, run)
    run.update(status="validated", completed_at=_now())
    return run, routed
