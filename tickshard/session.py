"""Session settings the package is used with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def builder(**settings: str) -> SparkSession.Builder:
    """A session builder with the settings above; keywords override or add."""
    build = SparkSession.builder.appName("tickshard")
    for key, value in {**SETTINGS, **settings}.items():
        build = build.config(key, value)
    return build


def configure(spark: SparkSession) -> SparkSession:
    """Give a session that exists already the zone the axis needs."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
