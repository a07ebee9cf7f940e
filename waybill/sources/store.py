"""Tables as folders of batches that become visible by one marker each.

``<path>/rows/batch=<name>/kind=<table>/bucket=<n>`` holds what a batch wrote to all tables, and
``<path>/markers/batch=<name>`` one row that says it is complete. Readers take the batches that have a
marker, so the tables of a batch appear together or not at all, and what a writer that died left
behind is never read. A batch of a known run always has the same name and is written with overwrite, so
doing it again replaces whatever is there.

Rows are only added. They carry the number of their commit; of shipments and failed events the row with
the highest number counts (``max_by`` at read). The ids of stored events are a narrow table of their
own. ``merge_small`` joins batches of similar size into one, ids by buckets: readers take a logarithmic
number of folders however many batches there were, and a look-up of ids reads only the buckets that
its ids fall into.

One process writes at a time: ``writing`` is a lock per path within it.
"""

from __future__ import annotations

import math
import re
import threading
import time
import uuid
from collections import defaultdict
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import model as M
from .tables import SCHEMAS

FEED = "feed:"   # prefix of the sources whose batches carry the parked events on
NEWEST = {"shipments": "shipment_id", "failed_events": "failed_event_id"}
IDS = "event_ids"
# clocks are microseconds since 1970
_MARKER = ("commit_id long, name string, source string, number long, feed_commit long, feed_clock long, "
           "written_at long, id_buckets int, kinds map<string,long>, merged array<string>, done map<string,long>")
_PLACE = [T.StructField("commit_id", T.LongType()), T.StructField("batch", T.StringType()),
          T.StructField("kind", T.StringType()), T.StructField("bucket", T.IntegerType())]
_UNSORTED = -1                       # bucket of rows that are not dealt to buckets
_FILE_ROWS = 4_000_000
_LOCKS: dict[str, threading.RLock] = defaultdict(threading.RLock)


def _outcomes_schema(key: T.DataType) -> T.StructType:
    wire = {"event_id": key, "shipment_id": key, "schema_version": T.IntegerType(),
            "event_time": T.TimestampType(), "sequence_number": T.LongType()}
    fields = [T.StructField(n, wire.get(n, T.StringType())) for n, _ in M.WIRE_NAMES]
    fields += [T.StructField(n, t) for n, t in (
        ("payload", T.StringType()), ("topic", T.StringType()), ("partition", T.IntegerType()),
        ("offset", T.LongType()), ("arrival", T.StructType([
            T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType())])),
        ("received_at", T.TimestampType()), ("first_failed_at", T.TimestampType()),
        ("violation", T.StringType()), ("registered_carrier", T.StringType()),
        ("normalized_event_type", T.StringType()), ("stored", T.BooleanType()), ("applied", T.BooleanType()),
        ("outcome", T.StringType()), ("error_category", T.StringType()), ("parked", T.BooleanType()),
        ("attempts", T.IntegerType()), ("next_due_at", T.TimestampType()))]
    return T.StructType(fields)


_DEAD_LETTERS = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("original_topic", T.StringType()), T.StructField("original_partition", T.IntegerType()),
    T.StructField("original_offset", T.LongType()), T.StructField("error_category", T.StringType()),
    T.StructField("exception_type", T.StringType()), T.StructField("exception_message", T.StringType()),
    T.StructField("dead_lettered_at", T.TimestampType())])


def _now() -> int:
    return int(time.time() * 1_000_000)


class Log:
    """The batches that are visible, from their markers: a few dozen rows, whatever the history."""

    def __init__(self, markers: list):
        gone = {name for m in markers for name in m["merged"] or []}
        self.markers = sorted((m for m in markers if m["name"] not in gone), key=lambda m: m["commit_id"])
        # the one that lists others comes after them
        self.gone = [m["name"] for m in sorted(markers, key=lambda m: m["commit_id"]) if m["name"] in gone]
        self.last = max((m["commit_id"] for m in markers), default=0)
        feeds = [m for m in self.markers if m["feed_commit"] is not None]
        last = max(feeds, key=lambda m: m["feed_commit"], default=None)
        self.feed_commit = last["feed_commit"] if last else None
        self.feed_clock = last["feed_clock"] if last else None
        self._written_at = last["written_at"] if last else None

    def has(self, source: str, number: int) -> bool:
        """Was exactly this batch of this source committed? Numbers of merged batches are known as a maximum."""
        return any((m["source"] == source and m["number"] == number) or (m["done"] or {}).get(source, -1) >= number
                   for m in self.markers)

    def clock(self) -> int | None:
        """The feed's time now: that of the last feed batch, moved on by the time since it was written."""
        if self.feed_clock is None:
            return None
        return self.feed_clock + max(_now() - self._written_at, 0)


class Batch:
    """What a writer is about to commit. Nobody sees it before."""

    def __init__(self, store: "Store", log: Log, name: str | None):
        self.store, self.log, self.commit_id = store, log, log.last + 1
        self.name = re.sub(r"[^A-Za-z0-9_-]", "_", name) if name else uuid.uuid4().hex
        self._begun = False

    def put(self, tables: dict[str, DataFrame]) -> None:
        """Writes rows of several tables by one job; may be called again for more."""
        self.store._save(self, tables, "append" if self._begun else "overwrite")
        self._begun = True

    def rows(self, table: str) -> DataFrame:
        """The batch's own rows of a table, for its later steps."""
        try:
            return self.store._rows([self.name], table).drop("commit_id")
        except AnalysisException:      # it wrote no rows of this table, so there is no folder
            return self.store.spark.createDataFrame([], self.store.schemas[table])


class Store:
    """The tables under ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: T.DataType = T.StringType(), id_buckets: int = 64):
        self.spark, self.path, self.key, self.id_buckets = spark, path.rstrip("/"), key, id_buckets
        self.schemas = {
            "shipments": M.shipments_schema(key), "tracking_events": M.history_schema(key),
            "notifications": M.notifications_schema(key), "failed_events": M.failed_events_schema(key),
            "outcomes": _outcomes_schema(key), "dead_letters": _DEAD_LETTERS,
            IDS: T.StructType([T.StructField("event_id", key)])}

    def create(self) -> "Store":
        """Lays down a first marker; an existing store is left alone."""
        try:
            self.log()
        except AnalysisException:      # no markers folder
            self._mark("create", 0, "create", 0)
        return self

    @contextmanager
    def writing(self):
        with _LOCKS[self.path]:
            yield

    # --- batches -------------------------------------------------------------------------------

    def log(self) -> Log:
        """Where the store stands: one small job. Pass it on to read several tables of one state."""
        rows = self.spark.read.schema(_MARKER).parquet(f"{self.path}/markers").select(
            *[c.split()[0] for c in _MARKER.split(", ")]).collect()
        if any(r["id_buckets"] != self.id_buckets for r in rows):
            raise ValueError(f"the store has {rows[0]['id_buckets']} buckets of ids, not {self.id_buckets}")
        return Log(rows)

    def begin(self, log: Log | None = None, name: str | None = None) -> Batch:
        return Batch(self, log or self.log(), name)

    def commit(self, batch: Batch, source: str, number: int, clock: int | None = None) -> int:
        """Makes the batch's rows visible. ``clock`` is the feed's time, for batches of the feed."""
        feed = batch.commit_id if source.startswith(FEED) else None
        self._mark(batch.name, batch.commit_id, source, number, feed, clock, self._counted(batch))
        return batch.commit_id

    def _counted(self, batch: Batch) -> dict[str, int]:
        """Rows per table; Spark takes them from the files' footers."""
        if not batch._begun:
            return {}
        counted = self._read([batch.name], T.StructType([])).groupBy("kind").count().collect()
        return {r["kind"]: r["count"] for r in counted}

    def _mark(self, name, commit_id, source, number, feed_commit=None, clock=None, kinds=None, merged=None, done=None,
              written_at=None):
        row = (commit_id, name, source, number, feed_commit, clock, written_at or _now(), self.id_buckets, kinds or {}, merged or [], done or {})
        self.spark.createDataFrame([row], _MARKER).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/markers/batch={name}")

    # --- rows ----------------------------------------------------------------------------------

    def _save(self, batch: Batch, tables: dict[str, DataFrame], mode: str, bucketed: bool = False) -> None:
        parts = []
        for table, df in tables.items():
            schema = self.schemas[table]
            bucket = self.bucket_of(F.col("event_id")) if bucketed and table == IDS else F.lit(_UNSORTED)
            number = F.col("commit_id") if "commit_id" in df.columns else F.lit(batch.commit_id)
            parts.append(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema],
                                   number.cast("long").alias("commit_id"), F.lit(table).alias("kind"),
                                   bucket.cast("int").alias("bucket")))
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        writer = union.write.mode(mode).partitionBy("kind", "bucket").option("maxRecordsPerFile", _FILE_ROWS)
        if bucketed:                   # a look-up by id skips row groups whose filter does not know it
            writer = writer.option("parquet.bloom.filter.enabled#event_id", "true")
        writer.parquet(f"{self.path}/rows/batch={batch.name}")

    def _read(self, names: list[str], schema: T.StructType, kind: str | None = None) -> DataFrame:
        """Rows of the named batches. Only their folders are listed, with ``kind`` only those of that table."""
        tail = f"/kind={kind}" if kind else ""
        paths = [f"{self.path}/rows/batch={n}{tail}" for n in names]
        return (self.spark.read.schema(T.StructType(schema.fields + _PLACE))
                .option("basePath", f"{self.path}/rows").parquet(*paths))

    def _rows(self, names: list[str], table: str) -> DataFrame:
        schema = self.schemas[table]
        found = self._read(names, schema, table) if names else self.spark.createDataFrame(
            [], T.StructType(schema.fields + _PLACE))
        return found.select(*schema.fieldNames(), "commit_id")

    def _names(self, table: str, log: Log) -> list[str]:
        return [m["name"] for m in log.markers if table in (m["kinds"] or {})]

    def bucket_of(self, key):
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.id_buckets))

    def read(self, table: str, keys: DataFrame | None = None, log: Log | None = None) -> DataFrame:
        """The visible table. Of shipments and failed events the newest row per key; with ``keys`` (a
        DataFrame holding key values) rows of all other keys are not even grouped."""
        log = log or self.log()
        rows = self._rows(self._names(table, log), table)
        if keys is not None:
            rows = rows.join(keys, keys.columns, "left_semi")
        if table not in NEWEST:
            rows = rows.drop("commit_id")
            return rows.where(~F.col("parked")) if table == "outcomes" else rows
        return self._newest(rows, table).drop("commit_id")

    def _newest(self, rows: DataFrame, table: str) -> DataFrame:
        key, columns = NEWEST[table], [*self.schemas[table].fieldNames(), "commit_id"]
        newest = rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in columns if c != key]), "commit_id").alias("_row"))
        return newest.select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in columns])

    def stored_ids(self, keys: DataFrame, log: Log | None = None, broadcast: bool = True) -> DataFrame:
        """Those of ``keys`` (event_id) that are stored.

        ``broadcast`` says the keys were counted and fit: then the scan is pruned to the buckets they fall into
        and filtered where it is read. Otherwise both sides meet by id and bucket in a merge join; Catalyst
        puts a Bloom filter of the keys before the large side's shuffle where that pays.
        """
        log = log or self.log()
        names = self._names(IDS, log)
        if not names:
            return keys.select("event_id").where(F.lit(False))
        ids = self._read(names, self.schemas[IDS], IDS).select("event_id", "bucket")
        wanted = keys.select("event_id").distinct().withColumn("bucket", self.bucket_of(F.col("event_id")).cast("int"))
        # ids not dealt yet are in a bucket of their own; the comparison tells the planner that keys are selective
        wanted = wanted.select("event_id", F.explode(F.array("bucket", F.lit(_UNSORTED))).alias("bucket")).where(
            F.col("bucket") < self.id_buckets)
        return ids.join(F.broadcast(wanted) if broadcast else wanted, ["bucket", "event_id"], "left_semi").select("event_id")

    def parked(self, log: Log | None = None) -> DataFrame:
        """Events waiting for their shipment. Each feed batch takes all of them up and writes those that
        still wait, so they are in the last one."""
        log = log or self.log()
        rows = self._rows(self._names("outcomes", log), "outcomes")
        return rows.where(F.col("parked") & (F.col("commit_id") == F.lit(log.feed_commit))).drop("commit_id")

    def export(self, path: str) -> None:
        """The four tables as plain folders, newest rows only, for ``read_tables``."""
        log = self.log()
        for table in SCHEMAS:
            self.read(table, log=log).write.mode("overwrite").parquet(f"{path}/{table}")

    # --- layout --------------------------------------------------------------------------------

    def merge_small(self, fan: int = 16, least_rows: int = 100_000) -> int:
        """Joins batches of one size class into one, where there are ``fan`` of them; how many were joined.

        A class spans sizes up to ``fan`` times its least (everything below ``least_rows`` is one class), so
        a row is written again once per class: a handful of times in the life of a store. Superseded
        shipments and failed events, and parked events of earlier batches, go. Reads stay the same.
        """
        with self.writing():
            log = self.log()
            classes = defaultdict(list)
            for m in log.markers:
                rows = sum((m["kinds"] or {}).values())
                classes[max(0, int(math.log(max(rows, 1) / least_rows, fan)) + 1 if rows >= least_rows else 0)].append(m)
            due = next((ms for _, ms in sorted(classes.items()) if len(ms) >= fan), None)
            if due is None:
                return 0
            part = Log(due)
            batch = self.begin(log)
            tables = {}
            for table in {k for m in due for k in m["kinds"] or {}}:
                rows = self._rows(self._names(table, part), table)
                if table in NEWEST:
                    rows = self._newest(rows, table)
                if table == "outcomes":
                    rows = rows.where(~F.col("parked") | (F.col("commit_id") == F.lit(log.feed_commit)))
                if table == IDS:
                    rows = rows.repartition(self.bucket_of(F.col("event_id"))).sortWithinPartitions("event_id")
                else:
                    total = sum((m["kinds"] or {}).get(table, 0) for m in due)
                    rows = rows.coalesce(max(1, total // _FILE_ROWS))
                tables[table] = rows
            if tables:
                self._save(batch, tables, "overwrite", bucketed=True)
                batch._begun = True
            done: dict[str, int] = {}
            for m in due:
                for source, number in [(m["source"], m["number"]), *(m["done"] or {}).items()]:
                    done[source] = max(number, done.get(source, number))
            feeds = [m for m in due if m["feed_commit"] is not None]
            last = max(feeds, key=lambda m: m["feed_commit"], default=None)
            self._mark(batch.name, batch.commit_id, "merge", batch.commit_id, last and last["feed_commit"],
                       last and last["feed_clock"], self._counted(batch), [m["name"] for m in due], done,
                       last and last["written_at"])
            return len(due)

    def drop_merged(self) -> None:
        """Deletes the folders of batches that have been merged into others: rows first, then markers.
        Call it when no reader that began before the merge is left."""
        with self.writing():
            for name in self.log().gone:
                for folder in ("rows", "markers"):
                    path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}/batch={name}")
                    path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
