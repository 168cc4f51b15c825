"""Incremental CSV ingest: a Structured Streaming file source finds new files, each with its own header.

The stream lists files (path, time, size; their content is not read by it) and its checkpoint remembers which are done. Each
micro-batch groups its files by header, reads every group with its own columns as text, and writes one folder, named by the stream and the
batch: a batch that is tried again replaces itself, and no stream writes over another one's rows. A backfill is a stream with a checkpoint
of its own for its window. New columns are kept, missing ones are null, and rows that do not fit their header go whole to the rescue
column.
"""

from __future__ import annotations

import csv
import datetime
import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.text import sanitize_column
from lakeloom.operators.scans import without_ingested

RESCUED = "_rescued_data"
_FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
METADATA = ["bronze_ingestion_ts", "ingestion_date", "source_file_path", "source_file_name", "source_file_size", "source_file_modified", "master_run_id"]


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """Files in the landing folder: path, name, modified, size. Their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{csv,csv.gz}").load(landing).select("path", "modificationTime", "length")
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def is_initial(spark: SparkSession, checkpoint: str) -> bool:
    """No checkpoint, or an empty one."""
    p = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return not fs.exists(p) or not len(fs.listStatus(p))


def checkpoint_for(base: str, start: datetime.date | None = None, end: datetime.date | None = None) -> str:
    """A backfill window has a checkpoint of its own."""
    return base if start is None else f"{base}_backfill_{start:%Y%m%d}_{end:%Y%m%d}"


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file of any store, unzipped if its name ends in .gz; the rest is not read."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        plain = jvm.java.util.zip.GZIPInputStream(stream) if path.endswith(".gz") else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def header_of(line: str | None) -> tuple[str, ...]:
    """Column names of a first line: an empty name gets its place, names that recur get it too."""
    names = next(csv.reader([line])) if line else []
    low = [n.lower() for n in names]
    return tuple(f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names))


def read_group(spark: SparkSession, paths: Sequence[str], header: Sequence[str], names: Mapping[str, str], run_id: str, now: datetime.datetime) -> DataFrame:
    """Rows of files that share a header, under their table names, with the ingest metadata."""
    columns = [names.get(c, sanitize_column(c)) for c in header]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, RESCUED]])
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED).csv(list(paths))
    path = F.col("_metadata.file_path")
    at = F.lit(now).cast("timestamp")
    return raw.select(
        *columns, RESCUED, at.alias("bronze_ingestion_ts"), F.to_date(at).alias("ingestion_date"), path.alias("source_file_path"), F.element_at(F.split(path, "/"), -1).alias("source_file_name"),
        F.col("_metadata.file_size").alias("source_file_size"), F.col("_metadata.file_modification_time").alias("source_file_modified"), F.lit(run_id).alias("master_run_id"),
    )


def read_files(spark: SparkSession, paths: Sequence[str], names: Mapping[str, str], run_id: str, now: datetime.datetime) -> DataFrame | None:
    """Rows of all files by column name, whatever the order of their headers."""
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:  # a few KB of each file, without a Spark job
        for p, line in zip(sorted(paths), pool.map(lambda p: first_line(spark, p), sorted(paths)), strict=True):
            groups.setdefault(header_of(line), []).append(p)
    groups.pop((), None)  # files without a line
    out = None
    for header, files in groups.items():
        rows = read_group(spark, files, header, names, run_id, now)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _stream(spark: SparkSession, landing: str, table: str, checkpoint: str, names: Mapping[str, str], run_id: str, now: datetime.datetime | None, files_per_batch: int, prefix: str, pick: Callable[[DataFrame], DataFrame]) -> list[int]:
    """Run the stream over what it has not seen yet; the number of files of each batch that were picked."""
    done = []

    def land(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in pick(batch.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("modificationTime").alias("modified"))).select("path").collect()]
        if not paths:
            return
        session = batch.sparkSession
        rows = read_files(session, paths, names, run_id, now or datetime.datetime.now(datetime.UTC).replace(tzinfo=None))
        if rows is not None:
            # The stream's own id is in its checkpoint: another stream, or a new one, has another.
            stream = json.loads(first_line(session, f"{checkpoint.rstrip('/')}/metadata"))["id"].split("-")[0]
            rows.write.mode("overwrite").parquet(f"{table}/run={run_id}/batch={prefix}{stream}-{number}")
        done.append(len(paths))

    files = spark.readStream.schema(_FILES).format("binaryFile").option("pathGlobFilter", "*.{csv,csv.gz}").option("maxFilesPerTrigger", files_per_batch).load(landing)
    files.select("path", "modificationTime", "length").writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return done


def ingest(spark: SparkSession, landing: str, table: str, checkpoint: str, names: Mapping[str, str], run_id: str, now: datetime.datetime | None = None, files_per_batch: int = 1000) -> int:
    """Read what has landed since the last run into `table` (folders by batch); the number of batches.

    The driver holds the names of one batch's files, at most `files_per_batch`.
    """
    return len(_stream(spark, landing, table, checkpoint, names, run_id, now, files_per_batch, "", lambda files: files))


def backfill(spark: SparkSession, landing: str, table: str, checkpoint: str, names: Mapping[str, str], run_id: str, start: datetime.date, end: datetime.date, known: DataFrame | None = None, now: datetime.datetime | None = None, files_per_batch: int = 1000) -> int:
    """Read files modified in the window that are not known by (file_name, modified); the number of files.

    The window has a checkpoint of its own beside `checkpoint`, so a window that is filled again reads only what it has not read yet.
    """

    def pick(files: DataFrame) -> DataFrame:
        files = files.where(F.to_date("modified").between(F.lit(start), F.lit(end)))
        return files if known is None else without_ingested(files, known)

    return sum(_stream(spark, landing, table, checkpoint_for(checkpoint, start, end), names, run_id, now, files_per_batch, f"backfill-{start:%Y%m%d}-{end:%Y%m%d}-", pick))


def raw_table(spark: SparkSession, table: str) -> DataFrame:
    """All rows ingested so far, with every column ever seen."""
    return spark.read.option("mergeSchema", "true").parquet(table)


def entity_rows(raw: DataFrame, columns: Sequence[str], metadata: Sequence[str] = ("bronze_ingestion_ts", "master_run_id")) -> DataFrame:
    """One entity's declared columns and metadata; undeclared columns stay behind, a missing one is an error."""
    missing = sorted(set(columns) - set(raw.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return raw.select(*columns, *metadata)
