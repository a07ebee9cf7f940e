"""Detection of groups too large for one task.

Windows per event id or per shipment put a whole group into one task. That is right for parcel
journeys (a handful of rows) and wrong for a key that holds a large share of the feed. The
operators therefore treat heavy keys apart, with the same result.

Heavy keys are *estimated* from a hash sample of the arrivals. The estimate only decides which
exact path a key takes; no row is ever dropped because of it. A key is heavy above ``heavy_rows``
rows, so there are at most rows / heavy_rows of them: a few hundred thousand for 10^12 rows. They
are counted before they are broadcast; beyond ``broadcast_keys`` the joins with them stay sort-merge
joins, which AQE splits where they are skewed. The sample is a function of the data, so every evaluation, also after
a lost executor, picks the same keys.

Detection is one job over the key columns. Without heavy keys the plain plan is built, with no
trace of the other path in it.
"""

from __future__ import annotations

import atexit
import functools
import math
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SkewPolicy:
    heavy_rows: int = 4_000_000   # one task sorts and scans this many rows comfortably
    sample_every: int = 64        # the estimate looks at one arrival in this many
    chunk_rows: int = 1_000_000   # most rows of a heavy group scanned in one piece
    broadcast_keys: int = 1_000_000
    together_rows: int = 1_000_000  # a larger feed is shuffled once, by shipment, where its ids allow that
    shared_ids: int = 100_000     # most ids of several shipments for which that is done


DEFAULT = SkewPolicy()


@dataclass(frozen=True)
class HeavyKeys:
    """Heavy values of one key (``rows`` holds that column), and into how many pieces their groups are cut."""

    rows: DataFrame
    fits: bool
    pieces: int

    def side(self, df: DataFrame) -> DataFrame:
        """``df``, which has one row per heavy value, as the small side of a join."""
        return F.broadcast(df) if self.fits else df


def find_heavy(df: DataFrame, keys: list[str], policy: SkewPolicy = DEFAULT) -> dict[str, HeavyKeys]:
    """The heavy values of each of ``keys``.

    One scan serves all keys (grouping sets over the sample). A key without heavy values is absent
    from the result.
    """
    sampled = (
        df.select(*keys, F.xxhash64("arrival").alias("_h"))
        .where(F.pmod("_h", F.lit(policy.sample_every)) == 0)
    )
    heavy = (
        sampled.groupingSets([[k] for k in keys], *keys)
        .agg(F.concat_ws("", *[F.grouping(k).cast("string") for k in keys]).alias("_set"),
             (F.count("*") * policy.sample_every).alias("_rows"))
        .where(F.col("_rows") > policy.heavy_rows)
    )
    of_key = {k: "".join("0" if k == other else "1" for other in keys) for k in keys}
    named = heavy.where(F.coalesce(*[F.col(k).cast("string") for k in keys], F.lit(None)).isNotNull())
    found = {row["_set"]: row                                # at most one row per key column
             for row in named.groupBy("_set").agg(F.count("*").alias("keys"), F.sum("_rows").alias("rows")).collect()}
    return {k: HeavyKeys(
        heavy.where((F.col("_set") == of_key[k]) & F.col(k).isNotNull()).select(k),
        found[of_key[k]]["keys"] <= policy.broadcast_keys,
        # pieces of half the size on average: ranges are drawn from a sample, so sizes vary
        math.ceil(2 * found[of_key[k]]["rows"] / policy.chunk_rows)) for k in keys if of_key[k] in found}


def find_shared(events: DataFrame, policy: SkewPolicy = DEFAULT) -> tuple[bool, HeavyKeys | None]:
    """Whether the feed is worth bringing together by shipment alone, and the event ids that occur in
    more than one shipment (written out; None: there are none). It is not if the feed is small, if its
    rows without shipment would crowd one task, or if such ids are more than ``shared_ids``.

    All copies of any other id lie in one shipment, so rows that are together by shipment are
    together by id as well. Only ids and shipments are shuffled to tell, combined before the shuffle.
    """
    size = events.agg(F.count("*").alias("rows"), F.count_if(F.col("shipment_id").isNull()).alias("lost")).first()
    if size["rows"] <= policy.together_rows or size["lost"] > policy.heavy_rows:
        return False, None
    homes = events.where(F.col("event_id").isNotNull()).groupBy("event_id").agg(
        F.min("shipment_id").alias("_least"), F.max("shipment_id").alias("_most"))
    shared = cut_lineage(homes.where(F.col("_least") != F.col("_most")).select("event_id"))
    ids = shared.count()
    if ids > policy.shared_ids:
        return False, None
    return True, HeavyKeys(shared, True, 1) if ids else None


def in_pieces(df: DataFrame, key: str, heavy: HeavyKeys) -> DataFrame:
    """Heavy groups cut into pieces: adds ``_chunk``, which follows the arrival order within a group.

    Rows are dealt by ranges of (key, arrival). Spark draws the borders from a sample of the rows and
    compares whole arrivals, so pieces hold equal numbers of rows, however arrivals are spread and
    whatever their leading values are. Written out, as the piece is the partition a row was dealt to."""
    dealt = df.repartitionByRange(heavy.pieces, key, "arrival")
    return cut_lineage(dealt.withColumn("_chunk", F.spark_partition_id().cast("long")))


class _Detect:
    """Default of the operators' ``heavy`` argument: look for heavy keys first."""


DETECT = _Detect()


def resolve_heavy(heavy, df: DataFrame, key: str) -> HeavyKeys | None:
    """What the caller found (or ruled out with None), else the result of a detection on ``df``."""
    return find_heavy(df, [key]).get(key) if heavy is DETECT else heavy


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the cluster's shared folder and reads it back, for a result that several
    branches read. A Parquet table rather than ``checkpoint()``: each branch reads only its columns.
    The folder is deleted when the process ends."""
    spark = df.sparkSession
    folder = scratch_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the cluster's shared one, deleted when the process ends."""
    folder = f"{_shared_folder(spark)}/waybill-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, folder)
    return folder


def _delete(spark: SparkSession, folder: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session has ended before: the folder is left to the owner of the shared one
        return


def _shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = _local_folder(context.applicationId)
    return shared.rstrip("/")


@functools.cache
def _local_folder(application: str) -> str:
    """Stands in for the shared folder where driver and executors are one process."""
    return tempfile.mkdtemp(prefix=f"waybill-{application}-")
