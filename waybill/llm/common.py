"""Helpers shared by the operators: reading, shared scratch tables, shipping, text blocks in numpy.

Conventions of every operator: a null text counts as empty, other columns of the input are ignored
(only the named columns are selected, so clashing names cannot matter), repeated rows give repeated
results, and an empty table gives an empty result of the same schema.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: dict[str, str] = {}
_SCRATCH: dict[str, list[str]] = {}


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Gives the executors this package once per application; tasks import it by name."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="waybill-"), "waybill_llm.zip")
    with zipfile.ZipFile(target, "w") as archive:
        archive.write(os.path.join(root, "__init__.py"), "waybill/__init__.py")
        for name in sorted(os.listdir(os.path.join(root, "llm"))):
            if name.endswith(".py"):
                archive.write(os.path.join(root, "llm", name), f"waybill/llm/{name}")
    spark.sparkContext.addPyFile(target)
    _SHIPPED[app] = target


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset (tests), a folder of this process, set for the session."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="waybill-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = []
        atexit.register(_clean, spark, app)
    _SCRATCH[app].append(path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def _clean(spark: SparkSession, app: str) -> None:
    for path in _SCRATCH.pop(app, []):
        try:
            drop_folder(spark, path)
        except Exception:  # the session is gone: the folder stays for whoever owns the shared folder
            return


def written(df: DataFrame, name: str, partition_by: str | None = None, compression: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, and survives lost executors. ``zstd`` takes less
    disk, but holds native memory for every open column: for tables of few columns."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", compression)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc32_mod(column, n: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def as_text(column) -> pa.Array:
    """A string array without nulls, with 32-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def blocks(column, limit: int = 1 << 19):
    """(first row, last row, bytes, offsets) of consecutive rows with about ``limit`` bytes of UTF-8,
    never less than one whole row. Bytes are not copied."""
    text = as_text(column)
    n = len(text)
    if not n:
        return
    off = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + n + 1].astype(np.int64)
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1))
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def slices(batch: pa.RecordBatch, text_at: int, rows: int = 256, limit: int = 1 << 20):
    """Consecutive slices of a batch: at most ``rows`` rows and about ``limit`` bytes in column ``text_at``, one
    whole row at least. A worker that takes a batch by slices, and gives each back before it takes the next,
    holds no second copy of the batch."""
    column = batch.column(text_at)
    for a, b, _, _ in blocks(column, limit):
        for i in range(a, b, rows):
            yield batch.slice(i, min(rows, b - i))


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


_HELD: dict = {}


def held(key, build):
    """Tables of an operator, built once in a worker process. Workers are used again by later stages: what
    another operator held there goes first, and its memory back to the system."""
    if key not in _HELD:
        if _HELD:
            _HELD.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):      # other C libraries have no such call
                ctypes.CDLL("libc.so.6").malloc_trim(0)
        _HELD[key] = build()
    return _HELD[key]


def record_batches(spark: SparkSession, rows: int) -> None:
    """Rows that Spark puts into a record batch for workers, for what the session runs from here on. Few
    where whole texts go to and fro, as buffers outside the heap hold a batch several times; many where a
    worker combines the rows of a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between offsets."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[off[1:]] - sums[off[:-1]]


BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int):
    """Powers of an odd base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for k, base in enumerate((BASE, np.uint64(pow(int(BASE), -1, 1 << 64)))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal bytes."""
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal bytes. Eight bytes at a time go through a bijection
    that depends on their place, so no arrangement of repeated parts cancels out, as it does in sums of
    powers (``span_hashes``, which is for the many overlapping spans of one width)."""
    length = ends - starts
    pieces = np.maximum((length + 7) >> 3, 1)
    first = np.cumsum(pieces) - pieces
    owner = np.repeat(np.arange(len(starts)), pieces)
    place = np.arange(len(owner)) - first[owner]
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))[starts[owner] + 8 * place]
    left = np.minimum(length[owner] - 8 * place, 8).astype(np.uint64)
    eight &= np.where(left > 0, np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (np.uint64(8) - np.maximum(left, np.uint64(1)))),
                      np.uint64(0))
    mixed = mix(eight + (place + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    if not len(first):
        return mixed
    return mix(np.add.reduceat(mixed, first) + length.astype(np.uint64) * BASE)


def table_of(*chars) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(b"".join(chars))] = True
    return out


SPACE = table_of(b"\x20\x09\x0a\x0b\x0c\x0d")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, off: np.ndarray, delimiter: np.ndarray = SPACE):
    """(starts, ends, row) of maximal runs of bytes that are no delimiter, inside rows."""
    gap = delimiter[data]
    inside = off[:-1][off[:-1] < off[1:]]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    before[inside] = True
    after[off[1:][off[:-1] < off[1:]] - 1] = True
    starts = np.flatnonzero(~gap & before)
    ends = np.flatnonzero(~gap & after) + 1
    row = np.searchsorted(off, starts, "right") - 1
    return starts, ends, row


def gram_hashes(values: np.ndarray, row: np.ndarray, n: int):
    """(hashes of n consecutive values of a row, index of the first value)."""
    if len(values) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(values) - n + 1
    total = values[:m].copy()
    for j in range(1, n):
        total *= BASE
        total += values[j:j + m]
    first = np.flatnonzero(row[:m] == row[n - 1:])
    return mix(total[first]), first
