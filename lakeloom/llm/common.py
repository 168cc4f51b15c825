"""Shared helpers: shipping the package to workers, shared folders, Arrow text buffers and word arrays in numpy."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass takes; the working arrays are about ten times as large.
PIECE_BYTES = 1 << 19
#: Bytes of an Arrow batch between Spark and Python (a longer row is a batch of its own). It is held on both sides.
BATCH_BYTES = 8 << 20

#: Rows of ids that may be broadcast (a few MB), and rows of one key that a shuffled join may take before the key counts as hot.
BROADCAST_ROWS, HOT = 200_000, 1000
#: Files whose rows are numbered by their place in them.
FILES = 20_000

_U64 = np.uint64
_BASE = np.uint64(0x9E3779B97F4A7C15)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver runs from, and bound the Arrow batches that they get."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which all executors share. A local master may do without the setting; others may not."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = f"file:///tmp/lakeloom-checkpoints-{spark.sparkContext.applicationId}"
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def cut(df: DataFrame, top: str, name: str) -> DataFrame:
    """Write `df` as a table under `top` and read it back: lineage ends there, and any executor can reread it."""
    path = f"{top}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, df: DataFrame) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of `df` by quoted name, for use after a join with unused names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def is_scan(df: DataFrame) -> bool:
    """Whether each row of `df` is one row of a file, the same whenever it is read: a scan under filters and selections only."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def numbered(df: DataFrame, row: str, top: str) -> DataFrame:
    """`df` with a number for each row that is the same whenever the table is read again, whatever the executors.

    Rows of files get it from their file and their place there; the rows of any other plan are written down first.
    """
    path, place, number, of = (unused(x, df) for x in ("_path", "_place", "_number", "_of"))
    files: list[str] = []
    if is_scan(df):
        try:
            at = df.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
            files = sorted(r[0] for r in at.select(path).distinct().limit(FILES + 1).collect())
        except AnalysisException:  # files of another format, or a column of that name
            pass
    if not files or len(files) > FILES:
        return cut(df.select("*", F.monotonically_increasing_id().alias(row)), top, "rows")
    at = at.join(F.broadcast(df.sparkSession.createDataFrame(list(enumerate(files)), f"{number} long, {of} string")), F.col(path) == F.col(of))
    return at.select(*own_columns(df), (F.shiftleft(F.col(number), 40) + F.col(place)).alias(row))


def is_small(keys: DataFrame) -> bool:
    """Whether a table of ids may be broadcast, by its counted rows."""
    return keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def meet(df: DataFrame, on: Column, keys: DataFrame, how: str) -> DataFrame:
    """`df` joined with a table of ids of unknown size: broadcast if it is counted to be small, else a shuffle without a sort of `df`."""
    return df.join(F.broadcast(keys) if is_small(keys) else keys.hint("shuffle_hash"), on, how)


def hot_join(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Inner join on a column of both, which has no two rows alike in `one` and no nulls.

    A key of over HOT rows of `many` and over a thousandth of them (at most a thousand keys) meets `one` in a broadcast, so that no task
    gets all its rows; the others meet in a shuffle. Both tables are read more than once.
    """
    n = many.count()
    if n <= HOT:
        return many.join(one, key)
    hot = many.groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") > max(HOT, n // 1000)).select(key)
    hot = F.broadcast(one.join(F.broadcast(hot), key, "left_semi"))
    return many.join(hot.select(key), key, "left_anti").join(one, key).unionByName(many.join(hot, key))


def keep_rows(df: DataFrame, column: str, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows whose value of `column` passes `keep` (flags for a batch), with all columns, whatever their names."""
    at = df.columns.index(column)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(keep(b.column(at)), pa.bool_()))

    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(rows, plain.schema).toDF(*df.columns)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of a superseded table through Hadoop's file system, whatever store it is in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@functools.cache
def _libc():
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.malloc_trim.argtypes = [ctypes.c_size_t]
        return libc
    except (OSError, AttributeError):  # another C library
        return None


def release() -> None:
    """Give freed memory back to the system: a worker lives on after its task and keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; null gives no bytes."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def pieces(sizes: np.ndarray, most: int = PIECE_BYTES):
    """Consecutive ranges of rows of about `most` bytes each; a longer row stands alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield start, len(sizes)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; row i is bytes[offsets[i]:offsets[i + 1]], null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes whose `is_word` is true, cut at row starts: (starts, ends, number of words before each row, with a last entry)."""
    inside = is_word[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[heads[1:] - 1] = inside[heads[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U64(27))) * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))


def _byte_hashes(raw: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix((place.astype(np.uint64) << _U64(8)) + raw.astype(np.uint64) + _BASE)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the ascending, disjoint spans of `raw`, the same for equal bytes wherever they stand.

    Each (place in the span, byte) goes through a mixing function before the sum, so texts of a regular build do not clash as they do
    under a polynomial. Callers that need exact results compare the bytes. A piece of `raw` is worked on at a time.
    """
    out = np.empty(len(starts), np.uint64)
    n = (ends - starts).astype(np.int64)
    i = 0
    while i < len(starts):
        if n[i] > PIECE_BYTES:
            total = _U64(0)
            for at in range(0, int(n[i]), PIECE_BYTES):
                part = raw[starts[i] + at : min(starts[i] + at + PIECE_BYTES, ends[i])]
                total = _byte_hashes(part, np.arange(at, at + len(part))).sum(dtype=np.uint64) + total
            out[i] = total
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + PIECE_BYTES)))
        j = i + int(np.argmax(n[i:j] > PIECE_BYTES)) if (n[i:j] > PIECE_BYTES).any() else j
        size = n[i:j]
        stop = np.cumsum(size)
        place = np.arange(stop[-1]) - np.repeat(stop - size, size)
        total = np.zeros(int(stop[-1]) + 1, np.uint64)
        np.cumsum(_byte_hashes(raw[place + np.repeat(starts[i:j], size)], place), out=total[1:])
        out[i:j] = total[stop] - total[stop - size]
        i = j
    return mix(out)


def same_spans(raw: np.ndarray, starts: np.ndarray, other: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether raw[starts[i]:starts[i] + n[i]] equals other[at[i]:at[i] + n[i]], byte by byte, a piece at a time."""
    out = np.ones(len(n), bool)
    stop = np.cumsum(n)
    i = 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(stop, (stop[i - 1] if i else 0) + PIECE_BYTES, "right")))
        size = n[i:j]
        end = np.cumsum(size)
        step = np.arange(end[-1]) - np.repeat(end - size, size)
        differ = raw[step + np.repeat(starts[i:j], size)] != other[step + np.repeat(at[i:j], size)]
        out[i + np.searchsorted(end, np.flatnonzero(differ), "right")] = False
        i = j
    return out


#: ASCII letters A to Z to lower case, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
