"""Bulk reads of the four tables with their fixed schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import model as M

SCHEMAS = {
    "shipments": M.shipments_schema,
    "tracking_events": M.history_schema,
    "notifications": M.notifications_schema,
    "failed_events": M.failed_events_schema,
}


def read_tables(spark: SparkSession, path: str, key: T.DataType = T.StringType()) -> dict[str, DataFrame]:
    """The four tables from Parquet folders of their names under ``path``."""
    return {name: spark.read.schema(schema(key)).parquet(f"{path}/{name}") for name, schema in SCHEMAS.items()}
