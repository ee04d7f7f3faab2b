"""Shared helpers: words and hashes of Arrow text columns (numpy), tables
in the shared folder, size-checked broadcast."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aerocast.session import scratch_path, shared_dir, ship_package

NO_ID = 2 ** 63 - 1          # stands for a null id inside the operators; sorts last
CHUNK_BYTES = 1 << 20        # text bytes worked on at once
BROADCAST_ROWS = 1 << 20     # a key table up to this many 16-byte rows may be broadcast

_R = np.uint64(0x9E3779B97F4A7C15)
_RINV = np.uint64(pow(int(_R), -1, 2 ** 64))
_S = np.uint64(0xD6E8FEB86659FD93)
_SINV = np.uint64(pow(int(_S), -1, 2 ** 64))

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---- Spark side ----------------------------------------------------------

def prepare(spark: SparkSession) -> None:
    """Session settings that keep one Arrow batch of long texts small, and
    the texts of plans, of which the driver holds one per execution."""
    shared_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.maxPlanStringLength", "2000")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Larger Arrow batches for what is stored inside: rows of few bytes."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_did(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, text): ids without nulls (NO_ID for a null id), texts as given."""
    return docs.select(did(id_col).alias("did"), F.col(text_col).cast("string").alias("text"))


def did(id_col: str = "doc_id"):
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Lineage cut: written to the shared folder and read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables whose last reader is stored itself."""
    for t in tables:
        jvm, path = t.sparkSession._jvm, t.stored_path
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.count() <= rows


def semi_by(docs: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Semi/anti join that ships the keys to the texts while the key table
    has at most BROADCAST_ROWS rows (16 MB), and shuffles beyond that."""
    return docs.join(F.broadcast(keys) if small_enough(keys) else keys, on, how)


# ---- numpy side ----------------------------------------------------------

_POW: dict = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _POW.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        p = np.full(size, base, np.uint64)
        p[0] = 1
        _POW[int(base)] = have = np.cumprod(p, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base=_S, inv=_SINV) -> np.ndarray:
    """Hash of values[starts:ends] for many ranges: prefix sums of a
    polynomial, shifted back to the range's start, then mixed with the
    length."""
    n = len(values)
    with np.errstate(over="ignore"):
        c = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _powers(base, n), out=c[1:])
        h = (c[ends] - c[starts]) * _powers(inv, n + 1)[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, one text after the other, and the
    n + 1 offsets; a null text counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    if not len(offsets) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of each word, and per text the index of its
    first word (n + 1 entries).  Words hold no byte that ``gap`` marks:
    by default no 0x20 and no 0x09-0x0D."""
    n = len(data)
    ns = np.ones(n + 2, bool)
    ns[0] = ns[-1] = False
    np.logical_not(gap[data], out=ns[1:-1])
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(ns[1:-1] & (~ns[:-2] | first[:-1]))
    ends = np.flatnonzero(ns[1:-1] & (~ns[2:] | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each span (starts in order); bounded memory whatever
    the text's size."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + CHUNK_BYTES)))
        lo, hi = starts[i], ends[i:j].max()
        part = data[lo:hi]
        out[i:j] = range_hash(_LOWER[part] if lower else part, starts[i:j] - lo, ends[i:j] - lo, _R, _RINV)
        i = j
    return out


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about CHUNK_BYTES of text (a longer
    single text stays whole)."""
    for b in batches:
        if not b.num_rows:
            continue
        _, off = text_bytes(b.column(b.schema.get_field_index(text)))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK_BYTES, side="right")) - 1)
            yield b.slice(i, j - i)
            i = j


def merged(batches: Iterator[pa.RecordBatch], size: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``size`` bytes of text: the more texts
    at once, the fewer words are looked at twice."""
    held, n = [], 0
    for b in slices(batches, text):
        held.append(b)
        n += column(b, text).nbytes
        if n >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def give_back() -> None:
    """Freed memory that the allocators keep goes back to the system; where
    the C library has no such call, only Arrow's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """For mapInArrow: a Python worker lives on after its task, beside joins
    and other stages; it keeps what it remembers, not what it has freed."""
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def i64(a: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the signed longs Spark has."""
    return a.view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64)


def longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return column(batch, name).to_numpy(zero_copy_only=False)
