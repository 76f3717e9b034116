"""Health run: results to reports, alerts and routed payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from skyops.operators import health


def health_run(results: DataFrame, keys: Sequence[str], order: Sequence[str],
               hooks: Sequence[dict], user_thresholds: DataFrame | None = None,
               checks: Sequence[str] | None = None) -> dict[str, DataFrame]:
    spark = results.sparkSession
    latest = health.latest_results(health.select_checks(results, checks), keys, order)
    config = health.thresholds(spark, user_thresholds)
    alerts = health.result_alerts(latest, config)
    return {
        "report": health.report(latest, keys),
        "alerts": alerts,
        "payloads": health.route_alerts(alerts, health.routes_frame(spark, hooks), keys),
    }
