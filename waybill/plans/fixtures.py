"""Adapters that read the driver's tables as parcels and carrier feeds.

Feed A (from ``events``) has every outcome in it; feed B (from ``lineitem``) has the volume.
The constants below define the test data; their SQL twin is in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalized_code, wire_json

TOPIC = "carrier-tracking-events"
PARTITIONS = 6

_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_shipdate timestamp",
    "documents": "doc_id bigint, text string, source string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def tracking_number(key) -> F.Column:
    return F.concat(F.lit("SP"), F.lpad(F.col(key).cast("string"), 12, "0"))


def carrier_of(key) -> F.Column:
    last = F.pmod(F.col(key), F.lit(10))
    return (F.when(last == 8, "NORDEX").when(last == 9, "METROLINK")
            .when(F.pmod(F.col(key), F.lit(2)) == 0, "SWIFTPOST").otherwise("PACIFICA"))


def _as_shipments(df: DataFrame, **columns) -> DataFrame:
    """Freshly registered shipments: initial status, no applied event."""
    created = columns.pop("created_at")
    return df.select(
        columns["shipment_id"].alias("shipment_id"), columns["retailer_id"].alias("retailer_id"),
        columns["customer_id"].alias("customer_id"),
        columns["tracking_number"].alias("tracking_number"),
        columns["carrier_code"].alias("carrier_code"),
        F.lit("LABEL_CREATED").alias("current_status"),
        columns["estimate"].alias("estimated_delivery_date"),
        F.lit(None).cast("timestamp").alias("last_event_time"),
        F.lit(None).cast("long").alias("last_sequence_number"),
        F.lit(None).cast("timestamp").alias("last_received_at"),
        F.lit(0).cast("long").alias("version"),
        created.alias("created_at"), created.alias("updated_at"))


def all_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shipment per customer."""
    key = F.col("c_custkey")
    return _as_shipments(
        table(spark, sf_dir, "customer"), shipment_id=key,
        retailer_id=F.concat(F.lit("retailer-"), F.col("c_nationkey").cast("string")),
        customer_id=F.col("c_name"), tracking_number=tracking_number("c_custkey"),
        carrier_code=carrier_of("c_custkey"),
        estimate=F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(key, F.lit(60)).cast("int")),
        created_at=F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(key, F.lit(997))))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered shipments of feed A; one in 17 is missing on purpose."""
    return all_customers(spark, sf_dir).where(F.pmod(F.col("shipment_id"), F.lit(17)) != 0)


def feed_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded deliveries with redeliveries, stale, invalid, misdirected and unknown ones."""
    events = table(spark, sf_dir, "events")
    end = events.agg(F.max("ts")).scalar()
    k, user = F.col("k"), F.col("user_id")
    base = events.select(
        "event_id", "ts", "user_id",
        F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("k"))
    # each row once in its own slot; k % 10 = 3 rows once more, seven slots later
    sent = base.withColumn("arrival", F.explode(F.when(
        k % 10 == 3, F.array(F.col("event_id") * 2, (F.col("event_id") + 7) * 2 + 1))
        .otherwise(F.array(F.col("event_id") * 2))))
    swift = (F.when(k % 7 == 0, "SP_PICKUP").when(k % 7 == 1, " sp_transit ").when(k % 7 == 2, "SP_DEPOT")
             .when(k % 7 == 3, "SP_OFD").when(k % 7 == 4, "SP_DELAY").when(k % 7 == 5, "SP_ATTEMPT")
             .when(k >= 97, "SP_DELIVERED").otherwise("SP_CREATED"))
    pacific = (F.when(k % 7 == 0, "COLLECTED").when(k % 7 == 1, "moving").when(k % 7 == 2, "AT_TERMINAL")
               .when(k % 7 == 3, "COURIER_ROUTE").when(k % 7 == 4, "EXCEPTION_DELAY")
               .when(k % 7 == 5, "DELIVERY_FAILED").when(k >= 97, "COMPLETE").otherwise("MANIFESTED"))
    even = F.pmod(user, F.lit(2)) == 0
    return (
        sent.withColumn("_end", end)
        .select(
            "event_id",
            F.when(k == 50, 2).otherwise(1).alias("schema_version"),
            user.alias("shipment_id"),
            tracking_number("user_id").alias("tracking_number"),
            F.when(k == 51, "SWIFTPOST").otherwise(carrier_of("user_id")).alias("carrier_code"),
            F.when(k == 52, "SP_TELEPORTED").when(even | (k == 51), swift).otherwise(pacific)
            .alias("event_type"),
            F.col("ts").alias("event_time"),
            (F.floor(F.col("event_id") / 100).cast("long") + 1
             - F.when(k < 10, 5 * (k + 1)).otherwise(0)).alias("sequence_number"),
            F.lit(None).cast("string").alias("location"),
            F.lit(None).cast("string").alias("description"),
            F.concat(F.lit("corr-"), user.cast("string")).alias("correlation_id"),
            "arrival",
            F.timestamp_micros(F.unix_micros("_end") + F.col("arrival") * 1_000_000).alias("received_at"),
            F.lit(TOPIC).alias("topic"),
            F.pmod(user, F.lit(PARTITIONS)).cast("int").alias("partition"),
            F.col("arrival").alias("offset"),
        ))


def feed_a_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Feed A as two successive batches. The first ends in the middle of the arrival order; the
    second starts a quarter earlier, as after a restart that lost its last offsets."""
    feed = feed_a(spark, sf_dir)
    middle = feed.agg(F.floor((F.min("arrival") + F.max("arrival")) / 2)).scalar()
    cut = feed.withColumn("_middle", middle)
    return (cut.where(F.col("arrival") <= F.col("_middle")).drop("_middle"),
            cut.where(F.col("arrival") > F.floor(F.col("_middle") / 2)).drop("_middle"))


def feed_json(spark: SparkSession, sf_dir: str, corrupt: bool = False) -> DataFrame:
    """Feed A as it comes off the wire: JSON text in a broker envelope.

    With ``corrupt``, rows chosen by their event time's microseconds carry broken payloads: no
    JSON, empty, NULL, text for a number, an unknown carrier, a JSON null, an array.
    """
    feed = feed_a(spark, sf_dir)
    value = wire_json(feed)
    if corrupt:
        kind = F.pmod(F.unix_micros("event_time"), F.lit(40))
        value = (F.when(kind == 0, "not json").when(kind == 1, "")
                 .when(kind == 2, F.lit(None).cast("string"))
                 .when(kind == 3, F.replace(value, F.lit('"schemaVersion":1'), F.lit('"schemaVersion":"one"')))
                 .when(kind == 4, F.regexp_replace(value, '"carrierCode":"[A-Z]+"', '"carrierCode":"ACME"'))
                 .when(kind == 5, "null")
                 .when(kind == 6, F.concat(F.lit("["), value, F.lit("]")))
                 .otherwise(value))
    return feed.select(F.col("shipment_id").cast("string").alias("key"), value.alias("value"),
                       "topic", "partition", "offset", F.col("received_at").alias("timestamp"))


def feed_b_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a registered shipment of one carrier."""
    key = F.col("o_orderkey")
    return _as_shipments(
        table(spark, sf_dir, "orders"), shipment_id=key,
        retailer_id=F.concat(F.lit("retailer-"), F.pmod(F.col("o_custkey"), F.lit(25)).cast("string")),
        customer_id=F.col("o_custkey").cast("string"), tracking_number=tracking_number("o_orderkey"),
        carrier_code=F.lit("SWIFTPOST"), estimate=F.date_add(F.col("o_orderdate").cast("date"), 7),
        created_at=F.col("o_orderdate"))


def feed_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as scans; ids repeat with differing bodies, arrival is a composite order."""
    line = F.col("l_linenumber")
    code = (F.when(line == 1, "SP_CREATED").when(line == 2, "SP_PICKUP").when(line == 3, "SP_TRANSIT")
            .when(line == 4, "SP_DEPOT").when(line == 5, "SP_DELAY").when(line == 6, "SP_OFD")
            .otherwise("SP_DELIVERED"))
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + line).alias("event_id"),
        F.lit(1).alias("schema_version"),
        F.col("l_orderkey").alias("shipment_id"),
        tracking_number("l_orderkey").alias("tracking_number"),
        F.lit("SWIFTPOST").alias("carrier_code"),
        code.alias("event_type"),
        F.col("l_shipdate").alias("event_time"),
        line.cast("long").alias("sequence_number"),
        F.lit(None).cast("string").alias("location"),
        F.lit(None).cast("string").alias("description"),
        F.concat(F.lit("corr-"), F.col("l_orderkey").cast("string")).alias("correlation_id"),
        F.struct("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
                 "l_discount", "l_tax").alias("arrival"),
        # reception follows the arrival order, after every event time
        F.timestamp_seconds(F.lit(4_000_000_000) + F.col("l_partkey")).alias("received_at"),
        F.lit(TOPIC).alias("topic"),
        F.pmod(F.col("l_orderkey"), F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.col("l_partkey").alias("offset"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration requests, one per order; customers repeat, so tracking numbers do."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("request_id"),
        F.when(F.pmod(key, F.lit(31)) == 0, F.lit("  ")).otherwise(
            F.concat(F.lit("retailer-"), F.pmod(F.col("o_custkey"), F.lit(25)).cast("string")))
        .alias("retailer_id"),
        F.when(F.pmod(key, F.lit(37)) == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        tracking_number("o_custkey").alias("tracking_number"),
        F.when(F.pmod(key, F.lit(41)) == 0, "ACME").otherwise(carrier_of("o_orderkey")).alias("carrier_code"),
        F.date_add(F.col("o_orderdate").cast("date"), 7).alias("estimated_delivery_date"),
        F.col("o_orderdate").alias("requested_at"))


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimate revisions, one per order, for the shipment of its customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("revision_id"), F.col("o_custkey").alias("shipment_id"),
        F.date_add(F.col("o_orderdate").cast("date"), 5).alias("estimated_delivery_date"),
        F.col("o_orderdate").alias("revised_at"))


def request_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish requests of up to ten events: an array, or the bare object when it holds one."""
    feed = feed_a(spark, sf_dir)
    return (feed.select(F.floor(F.col("arrival") / 10).alias("request_id"), "arrival", wire_json(feed).alias("value"))
            .groupBy("request_id")
            .agg(F.array_sort(F.collect_list(F.struct("arrival", "value"))).alias("_rows"))
            .select("request_id", F.when(F.size("_rows") == 1, F.col("_rows")[0]["value"]).otherwise(
                F.concat(F.lit("["), F.array_join(F.col("_rows.value"), ","), F.lit("]"))).alias("document")))


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary rows as the feed's two message versions would declare them."""
    return (feed_a(spark, sf_dir)
            .select("carrier_code", normalized_code(F.col("event_type")).alias("code"), "schema_version")
            .distinct().select("carrier_code", "code", F.col("schema_version").cast("string").alias("status")))


KEY_TYPE = T.LongType()


def feed_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed A with broken fields of every kind, chosen by the event time's microseconds."""
    kind = F.pmod(F.unix_micros("event_time"), F.lit(40))

    def text(n):
        return F.repeat(F.lit("x"), n)

    null = F.lit(None)
    broken = {
        "event_id": {0: null}, "shipment_id": {7: null}, "event_time": {7: null},
        "tracking_number": {1: F.lit("   "), 2: text(129), 12: F.lit("")},
        "event_type": {3: F.lit("\t"), 13: text(65), 12: null}, "location": {5: text(256), 14: text(255)},
        "description": {6: text(513)}, "correlation_id": {4: text(65), 12: F.lit(" ")},
        "sequence_number": {8: F.lit(0), 12: null}, "carrier_code": {9: null},
        "schema_version": {10: null, 11: F.lit(0)},
    }
    feed = feed_a(spark, sf_dir).withColumn("_kind", kind)
    for name, cases in broken.items():
        c = F.col(name)
        for k, value in cases.items():
            c = F.when(F.col("_kind") == k, value).otherwise(c)
        feed = feed.withColumn(name, c)
    return feed.drop("_kind")


def gauges(outcomes: DataFrame, consumer_delay: int) -> DataFrame:
    """Gauge readings per minute: open failed events, and the lag of a consumer that is
    ``consumer_delay`` seconds behind. Runs over one row per minute."""
    minute = F.window("received_at", "60 seconds").getField("end").alias("window_end")
    per_minute = outcomes.groupBy(minute).agg(
        F.count_if(F.col("error_category").isNotNull()).alias("failed"), F.max("offset").alias("produced"))
    running = Window.orderBy("window_end").rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.orderBy(F.unix_timestamp("window_end")).rangeBetween(
        Window.unboundedPreceding, -consumer_delay)
    readings = per_minute.select(
        "window_end", F.sum("failed").over(running).cast("double").alias("review_backlog"),
        (F.max("produced").over(running) - F.coalesce(F.max("produced").over(behind), F.lit(0)))
        .cast("double").alias("consumer_lag"))
    return readings.unpivot(["window_end"], ["review_backlog", "consumer_lag"], "gauge", "value")
