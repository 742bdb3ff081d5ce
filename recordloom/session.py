"""Session settings that every operator assumes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "recordloom", **settings: str) -> SparkSession:
    """A session with ANSI arithmetic, UTC timestamps and adaptive execution."""
    conf = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | settings
    return SparkSession.builder.appName(app).config(map=conf).getOrCreate()


BATCH_BYTES = 4 << 20
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` from here on, whatever the length of texts; only ever lowered."""
    held = str(spark.conf.get(BYTES_SETTING, None)).rstrip("bB")
    if not (held.isdigit() and int(held) <= BATCH_BYTES):
        spark.conf.set(BYTES_SETTING, str(BATCH_BYTES))
