"""The session this package is written for."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(app: str = "loopwise", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in (SETTINGS | settings).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the workers this package, so that it need not be installed on them."""
    here = Path(__file__).resolve().parent
    packed = shutil.make_archive(f"{tempfile.mkdtemp(prefix='loopwise-')}/{here.name}", "zip", here.parent, here.name)
    spark.sparkContext.addPyFile(packed)  # Spark copies it to them
