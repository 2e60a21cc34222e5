"""Session settings every operator relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows go to Python in batches of bounded bytes, not only of 10,000 rows of any width.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings that change results (time zone, ANSI) or plans (AQE)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def session_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set SQL settings around an eager action; ``__`` in a name stands for a dot."""
    names = {name.replace("__", "."): str(value) for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="candleforge-")
    return f"{base.rstrip('/')}/candleforge/{label}-{uuid.uuid4().hex}"
