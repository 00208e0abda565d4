"""Reports in published versions.

A set of reports is written under ``versions/<id>`` and becomes the current one by
one row appended to ``published`` afterwards. Readers take the last published
version; while a set is written, or if writing dies, they still see the one before.
There is one publisher at a time."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from stationflow.sources.files import delete_folder

_PUBLISHED = "sequence long, version string, reports array<string>"


def _published(spark: SparkSession, base: str) -> list:
    """Published versions, the last first (a row for each, of a few bytes)."""
    try:
        rows = spark.read.schema(_PUBLISHED).parquet(f"{base}/published")
        return rows.orderBy("sequence", "version", ascending=False).collect()
    except AnalysisException:  # nothing published yet
        return []


def publish_reports(spark: SparkSession, base: str, reports: dict[str, DataFrame], *, keep: int = 2) -> str:
    """Write the reports as a new version, publish it, and remove the report
    tables of all but the last ``keep`` versions. Gives the version's id."""
    base = base.rstrip("/")
    before = _published(spark, base)
    version = uuid.uuid4().hex
    for name, report in reports.items():
        report.write.parquet(f"{base}/versions/{version}/{name}")
    row = [(before[0].sequence + 1 if before else 1, version, list(reports))]
    spark.createDataFrame(row, _PUBLISHED).coalesce(1).write.mode("append").parquet(f"{base}/published")
    for old in before[max(1, keep) - 1 :]:
        delete_folder(spark, f"{base}/versions/{old.version}")
    return version


def published_reports(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The reports of the last published version, by name (none: empty)."""
    base = base.rstrip("/")
    last = _published(spark, base)[:1]
    return {name: spark.read.parquet(f"{base}/versions/{row.version}/{name}") for row in last for name in row.reports}
