"""Tables as Parquet parts under numbered manifests: a write adds folders, and one renamed file makes them the table.

A manifest lists the parts of a version, its schema, and for each part what is known of its rows: the hash bucket of their keys, or the
least and greatest value of one column. So a keyed write reads and rewrites only the buckets that its keys fall into, a range is replaced
without touching the parts outside it, and an append touches nothing. Readers keep the version they have begun with. A writer that finds
its number taken fails: another one has written meanwhile.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LAYERS = ("bronze", "silver", "quarantine", "audit", "gold", "mart", "features", "semantic", "metrics")
BUCKET = "_bucket"


class WriteConflict(RuntimeError):
    """Another writer has made a version of the table meanwhile."""


class TableStore:
    """Tables by (layer, name) under one folder of any file system that Spark reads. Keyed tables have `buckets` buckets."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    # --- files ---

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def read_text(self, path: str) -> str:
        fs, p = self._path(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Write beside and rename, never over an existing file."""
        beside = f"{path.rsplit('/', 1)[0]}/.new-{uuid.uuid4().hex}"
        fs, p = self._path(beside)
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self.spark._jsc.hadoopConfiguration())
        no_options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(p, jvm.org.apache.hadoop.fs.Path(path), no_options)
        except Exception as e:
            fs.delete(p, False)
            raise WriteConflict(f"{path} is there already") from e

    # --- versions ---

    def bootstrap(self, layers: Sequence[str] = LAYERS) -> list[str]:
        """Make the folders of the layers that are missing; their names."""
        made = []
        for layer in layers:
            fs, p = self._path(f"{self.root}/{layer}")
            if not fs.exists(p):
                fs.mkdirs(p)
                made.append(layer)
        return made

    def folder(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        return f"{self.root}/{layer}/{name}"

    def version(self, layer: str, name: str) -> int:
        """Number of the current version, 0 if there is no table."""
        return max((int(n[:-5]) for n in self._names(f"{self.folder(layer, name)}/_manifest") if n.endswith(".json") and not n.startswith(".")), default=0)

    def manifest(self, layer: str, name: str) -> dict | None:
        n = self.version(layer, name)
        return json.loads(self.read_text(f"{self.folder(layer, name)}/_manifest/{n:08d}.json")) | {"version": n} if n else None

    def exists(self, layer: str, name: str) -> bool:
        return self.version(layer, name) > 0

    def _commit(self, layer: str, name: str, before: dict | None, parts: list[dict], schema: StructType, **about) -> None:
        n = (before or {}).get("version", 0) + 1
        held = {k: v for k, v in (before or {}).items() if k in ("cluster_by", "keys", "buckets")} | about
        text = json.dumps({"parts": parts, "schema": schema.jsonValue(), **held}, sort_keys=True)
        self._path(f"{self.folder(layer, name)}/_manifest")[0].mkdirs(self._path(f"{self.folder(layer, name)}/_manifest")[1])
        self.write_text(f"{self.folder(layer, name)}/_manifest/{n:08d}.json", text)

    def _read_parts(self, layer: str, name: str, parts: list[dict], schema: StructType) -> DataFrame:
        paths = [f"{self.folder(layer, name)}/{p['path']}" for p in parts]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, layer: str, name: str) -> DataFrame:
        m = self.manifest(layer, name)
        if m is None:
            raise LookupError(f"no table {layer}.{name}")
        return self._read_parts(layer, name, m["parts"], StructType.fromJson(m["schema"]))

    def read_or_empty(self, layer: str, name: str, schema: StructType) -> DataFrame:
        return self.read(layer, name) if self.exists(layer, name) else self.spark.createDataFrame([], schema)

    # --- writes ---

    def replace(self, layer: str, name: str, df: DataFrame, cluster_by: tuple[str, ...] = ()) -> None:
        """Write a new version (clustered by range of up to four columns). The old one stays for its readers."""
        if cluster_by:
            validate_cluster_columns(cluster_by)
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        before, part = self.manifest(layer, name), f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder(layer, name)}/{part}")
        self._commit(layer, name, before, [{"path": part}], df.schema, cluster_by=list(cluster_by))

    def append(self, layer: str, name: str, df: DataFrame) -> None:
        """Add rows; new columns are added to the table, and other rows have null there. Readers see all of the rows or none."""
        before, part = self.manifest(layer, name), f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder(layer, name)}/{part}")
        old = StructType.fromJson(before["schema"]) if before else None
        self._commit(layer, name, before, [*(before["parts"] if before else []), {"path": part}], merged_schema(old, df.schema))

    def create(self, layer: str, name: str, schema: StructType) -> None:
        """An empty table, unless it exists."""
        if not self.exists(layer, name):
            self._commit(layer, name, None, [], schema)

    def replace_range(self, layer: str, name: str, df: DataFrame, column: str, low: datetime.datetime | None, high: datetime.datetime | None) -> int:
        """The table without its rows of column values in [low, high) (None: no bound), and with those of `df`; the number of rows added.

        Parts outside the range stay as they are; parts that lie across a bound are filtered. Null lies in the range only if it has no bounds.
        """
        before = self.manifest(layer, name)
        schema = merged_schema(StructType.fromJson(before["schema"]) if before else None, df.schema)
        stay, across, unbounded = [], [], low is None and high is None
        for p in before["parts"] if before else []:
            least, most = (None if p.get(k) is None else datetime.datetime.fromisoformat(p[k]) for k in ("least", "most"))
            if unbounded:
                continue
            known = p.get("column") == column and not p.get("nulls") and least is not None
            if known and (low is not None and most < low or high is not None and least >= high):
                stay.append(p)
            elif not (known and (low is None or least >= low) and (high is None or most < high)):
                across.append(p)
        bounds = [c for c in (F.col(column) >= F.lit(low) if low is not None else None, F.col(column) < F.lit(high) if high is not None else None) if c is not None]
        parts = list(stay)
        if across:
            inside = bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]
            kept = self._write_ranged(layer, name, self._read_parts(layer, name, across, schema).where(~F.coalesce(inside, F.lit(False))), column)
            parts += [kept] if kept["rows"] else []
        new = self._write_ranged(layer, name, df, column)
        self._commit(layer, name, before, parts + ([new] if new["rows"] else []), schema)
        return new["rows"]

    def _write_ranged(self, layer: str, name: str, df: DataFrame, column: str) -> dict:
        part, seen = f"v-{uuid.uuid4().hex}", Observation()
        at = F.col(column).cast("timestamp")
        df.observe(seen, F.count("*").alias("n"), F.min(at).alias("least"), F.max(at).alias("most"), F.count_if(at.isNull()).alias("nulls")).write.parquet(f"{self.folder(layer, name)}/{part}")
        text = lambda x: None if x is None else x.isoformat()
        return {"path": part, "column": column, "least": text(seen.get["least"]), "most": text(seen.get["most"]), "nulls": seen.get["nulls"], "rows": seen.get["n"]}

    def rewrite(self, layer: str, name: str, source: DataFrame, keys: Sequence[str], plan: Callable[[DataFrame, DataFrame], DataFrame], measures: Mapping[str, Column] | None = None, drop: Sequence[str] = ()) -> dict:
        """Apply `plan(target, source)` to the buckets that the source's keys fall into; the measures of its rows, taken as they are written.

        `plan` gets the rows of these buckets only, and must not need others. `drop` are columns that are measured but not kept.
        """
        before = self.manifest(layer, name)
        if before is None:
            raise LookupError(f"no table {layer}.{name}")
        merged_schema(StructType.fromJson(before["schema"]), source.schema)
        same = before.get("keys") == list(keys)
        n = before["buckets"] if same else self.buckets
        bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(n)).cast("int")
        touched = {r[0] for r in source.select(bucket.alias(BUCKET)).distinct().collect()}  # at most the number of buckets
        stay = [p for p in before["parts"] if same and BUCKET in p and p[BUCKET] not in touched]
        hit = [p for p in before["parts"] if p not in stay]
        out = plan(self._read_parts(layer, name, hit, StructType.fromJson(before["schema"])), source)
        seen = Observation()
        if measures:
            out = out.observe(seen, *[c.alias(k) for k, c in measures.items()])
        out = out.drop(*drop)
        schema, folder = merged_schema(StructType.fromJson(before["schema"]), out.schema), f"v-{uuid.uuid4().hex}"
        path = f"{self.folder(layer, name)}/{folder}"
        # One more shuffle, sized while it runs, so that a bucket is a few files and not one for each task.
        rows = out.withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
        rows.sortWithinPartitions(BUCKET, *keys).write.partitionBy(BUCKET).parquet(path)
        new = [{"path": f"{folder}/{d}", BUCKET: int(d.split("=")[1])} for d in self._names(path) if d.startswith(f"{BUCKET}=")]
        self._commit(layer, name, before, stay + new, schema, keys=list(keys), buckets=n, cluster_by=list(keys))
        return dict(seen.get) if measures else {}

    # --- views, layout, upkeep ---

    def view(self, layer: str, name: str, view: str) -> None:
        """The table under a name of this session."""
        self.read(layer, name).createOrReplaceTempView(view)

    def define_view(self, name: str, sql: str) -> None:
        """Keep a view's statement; the last one of a name counts. `open_views` makes the views in a session."""
        folder = f"{self.root}/_views/{name}"
        fs, p = self._path(folder)
        fs.mkdirs(p)
        n = max((int(x[:-4]) for x in self._names(folder) if x.endswith(".sql") and not x.startswith(".")), default=0) + 1
        self.write_text(f"{folder}/{n:08d}.sql", sql)

    def open_views(self) -> list[str]:
        """Make all kept views in this session; their names. Statements name tables as layer__name."""
        for layer in LAYERS:
            for name in self._names(f"{self.root}/{layer}"):
                if self.exists(layer, name):
                    self.view(layer, name, f"{layer}__{name}")
        names = self._names(f"{self.root}/_views")
        for name in names:
            last = [x for x in self._names(f"{self.root}/_views/{name}") if x.endswith(".sql") and not x.startswith(".")][-1]
            self.spark.sql(self.read_text(f"{self.root}/_views/{name}/{last}")).createOrReplaceTempView(name)
        return names

    def converge(self, layer: str, name: str, wanted: tuple[str, ...], allow_rewrite: bool = False) -> str:
        """Bring a table to the wanted clustering: what was to be done (see plan_layout). Data is rewritten only where that is allowed."""
        m = self.manifest(layer, name)
        if m is None:
            raise LookupError(f"no table {layer}.{name}")
        schema = StructType.fromJson(m["schema"])
        if missing := missing_cluster_columns(schema.names, wanted):
            raise ValueError(f"missing columns: {', '.join(missing)}")
        todo = plan_layout((), tuple(m.get("cluster_by") or ()), wanted)
        if todo != "NOTHING":
            if allow_rewrite:
                self.replace(layer, name, self.read(layer, name), wanted)
            else:
                self._commit(layer, name, m, m["parts"], schema, cluster_by=list(wanted))
        return todo

    def vacuum(self, layer: str, name: str) -> int:
        """Delete parts and manifests that are not of the current version; the number of parts."""
        m = self.manifest(layer, name)
        if m is None:
            return 0
        folder = self.folder(layer, name)
        for old in self._names(f"{folder}/_manifest"):
            if old != f"{m['version']:08d}.json":
                fs, p = self._path(f"{folder}/_manifest/{old}")
                fs.delete(p, False)
        kept, gone = {p["path"] for p in m["parts"]}, 0
        for part in self._names(folder):
            inner = [f"{part}/{d}" for d in self._names(f"{folder}/{part}") if d.startswith(f"{BUCKET}=")] if part.startswith("v-") else []
            for path in inner or ([part] if part.startswith("v-") else []):
                if path not in kept:
                    fs, p = self._path(f"{folder}/{path}")
                    fs.delete(p, True)
                    gone += 1
        return gone


def merged_schema(old: StructType | None, new: StructType) -> StructType:
    """The old columns, then the new ones; a column of two types is an error."""
    if old is None:
        return new
    kinds = {f.name: f.dataType.simpleString() for f in old}
    clash = [f.name for f in new if f.name in kinds and f.dataType.simpleString() != kinds[f.name]]
    if clash:
        raise ValueError(f"columns of another type: {', '.join(sorted(clash))}")
    return StructType([*old.fields, *[f for f in new if f.name not in kinds]])


def validate_cluster_columns(columns: tuple[str, ...]) -> None:
    if not 1 <= len(columns) <= 4 or len(set(columns)) != len(columns):
        raise ValueError("one to four different columns")


def missing_cluster_columns(columns: Sequence[str], wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c not in columns]


def plan_layout(partitioned_by: tuple[str, ...], clustered_by: tuple[str, ...], wanted: tuple[str, ...]) -> str:
    """NOTHING, ALTER_CLUSTER_BY or CONVERT_PARTITIONED."""
    validate_cluster_columns(wanted)
    return "CONVERT_PARTITIONED" if partitioned_by else "NOTHING" if tuple(clustered_by) == tuple(wanted) else "ALTER_CLUSTER_BY"


def inventory(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows of each known table in the given order, 0 where it is missing."""
    parts = []
    for place, (name, path) in enumerate(paths.items(), 1):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
        n = spark.read.parquet(path).agg(F.count("*").alias("rows")) if there else spark.range(1).select(F.lit(0).cast("long").alias("rows"))
        parts.append(n.select(F.lit(name).alias("name"), "rows", F.lit(place).alias("place")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("place")
