"""Tables as snapshots: Parquet folders that are never changed, and a manifest that names those which make up a version.

``data/commit=C/<partition>`` holds what commit C wrote of a partition, ``log/commit=C`` the rows it inserted, updated or
deleted, ``index/commit=C`` where the keys that it placed live. A manifest (``manifests/<version>.json``) says which
commits' folders make up each partition; its size follows the number of partitions, not of rows or files. A writer writes
its folders first and commits by renaming one manifest into place, which fails if that version is already there. So readers
see all of a commit or nothing, a writer that dies leaves folders nobody names (``expire`` removes them), and of
two writers one gets ``Conflict`` and has to start from the new version. The file system must not rename over existing files
(HDFS and local disks do not).

Marks are a consumer's own notes in its manifest, such as the version of the table it has read up to. They are committed
together with what was made of it, so work that is repeated after a failure is not done twice.
"""

from __future__ import annotations

import dataclasses
import json
import time
import uuid
from collections.abc import Callable, Collection, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
SLOTS = 64  # of the key index
MOST_FOLDERS = 8  # a partition made of more is rewritten when rows are added to it
MOST_INDEX = 16  # commits with an index folder of their own
ROWS_PER_FILE = 500_000


class Conflict(RuntimeError):
    """Another writer committed this version first."""


class Expired(LookupError):
    """The log is no longer kept as far back as asked."""


@dataclasses.dataclass(frozen=True)
class Snapshot:
    version: int = 0
    schema: str | None = None
    columns: tuple[str, ...] = ()  # that partition the table
    parts: dict[str, list[str]] = dataclasses.field(default_factory=dict)  # partition -> commits
    index: tuple[str, ...] = ()
    changed: tuple[str, ...] = ()  # partitions that this version wrote or dropped
    log: str | None = None
    whole: bool = False  # all that commit ``log`` wrote is new; it has no log of its own
    marks: dict = dataclasses.field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


# ---- manifests -----------------------------------------------------------------------------

def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or a file that nothing names."""
    _fs(spark, path).delete(_path(spark, path), True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions whose manifests are kept."""
    found = _fs(spark, path).globStatus(_path(spark, f"{path}/manifests/*.json"))
    return sorted(int(s.getPath().getName().removesuffix(".json")) for s in found or ())


def load(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """A version of a table, the newest one if none is named; version 0 is the table without a row."""
    if version is None:
        version = (versions(spark, path) or [0])[-1]
    if not version:
        return Snapshot()
    name = f"{path}/manifests/{version:012d}.json"
    stream = _fs(spark, path).open(_path(spark, name))
    try:
        fields = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Snapshot(**{k: tuple(v) if k in ("columns", "index", "changed") else v for k, v in fields.items()})


def keeps(spark: SparkSession, path: str, first: int, last: int) -> bool:
    """Whether the manifests of these versions are all still there."""
    return set(versions(spark, path)).issuperset(range(first, last + 1))


def written_since(spark: SparkSession, path: str, now: Snapshot, after: int) -> set[str]:
    """Partitions that versions after ``after`` wrote or dropped; all there are, where manifests are no longer kept."""
    if not keeps(spark, path, after + 1, now.version):
        return set(now.parts)
    return {p for v in range(after + 1, now.version + 1) for p in load(spark, path, v).changed}


def commit(spark: SparkSession, path: str, snapshot: Snapshot) -> Snapshot:
    """Make ``snapshot`` the newest version. This rename is the only step that readers notice."""
    target, draft = f"{path}/manifests/{snapshot.version:012d}.json", f"{path}/manifests/.{uuid.uuid4().hex}"
    out = _fs(spark, path).create(_path(spark, draft))
    try:
        out.write(bytearray(json.dumps(dataclasses.asdict(snapshot)).encode()))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_fs(spark, path).getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(_path(spark, draft), _path(spark, target), no_options)
    except Py4JJavaError as error:
        remove(spark, draft)
        if "FileAlreadyExists" in str(error.java_exception):
            raise Conflict(f"version {snapshot.version} of {path} is already there") from None
        raise
    return snapshot


def expire(spark: SparkSession, path: str, keep: int = 10, grace_seconds: float = 86_400) -> list[str]:
    """Drop all but the newest ``keep`` versions, and the folders that none of those names. Folders younger than
    ``grace_seconds`` stay, as a writer may be about to commit them. Returns the folders removed."""
    kept = versions(spark, path)[-keep:]
    named = set()
    for version in kept:
        s = load(spark, path, version)
        named |= {f"data/commit={c}" for p in s.parts.values() for c in p} | {f"index/commit={c}" for c in s.index}
        if s.log:
            named.add(f"{'data' if s.whole else 'log'}/commit={s.log}")
    fs, gone = _fs(spark, path), []
    for version in set(versions(spark, path)) - set(kept):
        fs.delete(_path(spark, f"{path}/manifests/{version:012d}.json"), False)
    for kind in ("data", "log", "index", "work"):
        for status in fs.globStatus(_path(spark, f"{path}/{kind}/commit=*")) or ():
            name = f"{kind}/{status.getPath().getName()}"
            if name not in named and status.getModificationTime() < (time.time() - grace_seconds) * 1000:
                fs.delete(status.getPath(), True)
                gone.append(name)
    return sorted(gone)


# ---- reading -------------------------------------------------------------------------------

def part_name(values: dict[str, object]) -> str:
    return "/".join(f"{c}={NO_VALUE if v is None else v}" for c, v in values.items())


def part_values(part: str) -> dict[str, str | None]:
    pairs = (p.split("=", 1) for p in part.split("/") if p)
    return {c: None if v == NO_VALUE else v for c, v in pairs}


def part_of(columns: Sequence[str]) -> Column:
    """The name of the partition a row lies in."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE))) for c in columns])


def _folders(spark: SparkSession, path: str, kind: str, names: Sequence[str], schema: T.StructType, **options: str) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    base = f"{path}/{kind}"
    found = spark.read.options(**options).schema(T.StructType([*schema.fields, T.StructField("commit", T.StringType())]))
    return found.option("basePath", base).parquet(*[f"{base}/{n}" for n in names]).select(*schema.names)


def read(spark: SparkSession, path: str, parts: Collection[str] | None = None, snapshot: Snapshot | None = None,
         **options: str) -> DataFrame:
    """A version of a table, or some partitions of it: only their folders are listed and opened."""
    s = snapshot or load(spark, path)
    if s.schema is None:
        raise FileNotFoundError(f"{path} has no version")
    names = [f"commit={c}/{p}".rstrip("/") for p, commits in sorted(s.parts.items()) if parts is None or p in parts for c in commits]
    return _folders(spark, path, "data", names, s.struct, **options)


def changes(spark: SparkSession, path: str, after: int, upto: int | None = None) -> DataFrame:
    """The rows that the versions after ``after`` inserted, updated (as they became) or deleted (as they were), with ``change``
    and ``snapshot``, the version. No table version is read, only what these versions logged."""
    known = versions(spark, path)
    last = (known or [0])[-1] if upto is None else upto
    if wanted := [v for v in range(after + 1, last + 1) if v not in set(known)]:
        raise Expired(f"the log of version {wanted[0]} of {path} is not kept")
    news = [load(spark, path, v) for v in range(after + 1, last + 1)]
    s = load(spark, path, last or None)
    if s.schema is None:
        raise FileNotFoundError(f"{path} has no version")
    layout = T.StructType([T.StructField("change", T.StringType()), T.StructField("snapshot", T.LongType()), *s.struct.fields])
    out = _folders(spark, path, "log", [f"commit={n.log}" for n in news if n.log and not n.whole], layout)
    for n in (n for n in news if n.whole):
        names = [f"commit={n.log}/{p}".rstrip("/") for p, commits in sorted(n.parts.items()) if n.log in commits]
        rows = _folders(spark, path, "data", names, n.struct)
        out = out.unionByName(rows.select(F.lit("insert").alias("change"), F.lit(n.version).cast("long").alias("snapshot"), "*"),
                              allowMissingColumns=True)
    return out


def latest_changes(spark: SparkSession, path: str, key: str, after: int, upto: int | None = None) -> DataFrame:
    """The last change of each key after a version; keys that were deleted last are left out."""
    feed = changes(spark, path, after, upto)
    columns = [c for c in feed.columns if c not in ("change", "snapshot")]
    last = feed.groupBy(key).agg(F.max(F.struct("snapshot", "change", *[c for c in columns if c != key])).alias("r"))
    return last.where("r.change <> 'delete'").select(*[key if c == key else F.col(f"r.{c}") for c in columns])


def homes(spark: SparkSession, path: str, keys: DataFrame, key: str, snapshot: Snapshot | None = None) -> DataFrame:
    """(key, home): the partition each of ``keys`` lies in, by the index; keys that are nowhere are left out. Opens the
    slots of these keys only, MOST_INDEX files of each at most, however many partitions there are."""
    s = snapshot or load(spark, path)
    if s.parts and not s.index:  # written without an index: look the keys up in the table itself
        held = read(spark, path, None, s).join(keys.select(key).distinct(), key, "left_semi")
        return held.groupBy(key).agg(F.max(part_of(s.columns)).alias("home"))
    layout = T.StructType([T.StructField("k", T.StringType()), T.StructField("home", T.StringType()),
                           T.StructField("snapshot", T.LongType()), T.StructField("slot", T.IntegerType())])
    index = _folders(spark, path, "index", [f"commit={c}" for c in s.index], layout)
    wanted = keys.select(F.col(key).cast("string").alias("k")).where("k is not null").distinct()
    slots = [r[0] for r in wanted.select(_slot("k").alias("slot")).distinct().collect()]  # SLOTS rows at most
    found = index.where(F.col("slot").isin(slots)).join(wanted, "k", "left_semi")
    return found.groupBy("k").agg(F.max_by("home", "snapshot").alias("home")).select(F.col("k").alias(key), "home")


# ---- writing -------------------------------------------------------------------------------

def _slot(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(SLOTS)).cast("int")


def _write(df: DataFrame, path: str, columns: Sequence[str], sort_cols: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE) -> None:
    """The REBALANCE hint lets Spark split a partition value that holds much of the data over several tasks and put small
    ones together, which a plain repartition by these columns cannot."""
    out = df.hint("rebalance", *[F.col(c) for c in columns])
    if sort_cols:
        out = out.sortWithinPartitions(*columns, *sort_cols)
    writer = out.write.option("compression", "snappy").option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*columns) if columns else writer).parquet(path)


def _written_parts(spark: SparkSession, path: str, name: str, columns: Sequence[str]) -> list[str]:
    """The partitions a commit has folders of."""
    if not columns:
        return [""]
    base = f"{path}/data/commit={name}"
    found = _fs(spark, path).globStatus(_path(spark, "/".join([base, *["*=*"] * len(columns)]))) or ()
    return sorted("/".join(str(s.getPath()).split("/")[-len(columns):]) for s in found)


def _new_index(spark: SparkSession, path: str, name: str, s: Snapshot, version: int, rows: DataFrame, keep: bool) -> tuple[str, ...]:
    """Index folders after a commit that placed ``rows`` (k, home). Many small ones are merged into one."""
    rows = rows.where("k is not null").select("k", "home", F.lit(version).cast("long").alias("snapshot"), _slot("k").alias("slot"))
    kept = s.index if keep else ()
    if len(kept) >= MOST_INDEX:
        older = _folders(spark, path, "index", [f"commit={c}" for c in kept], rows.schema)
        rows = (older.unionByName(rows).groupBy("k", "slot").agg(F.max(F.struct("snapshot", "home")).alias("r"))
                .select("k", "r.home", "r.snapshot", "slot"))
        kept = ()
    rows.hint("rebalance", F.col("slot")).sortWithinPartitions("slot", "k").write.partitionBy("slot").parquet(f"{path}/index/commit={name}")
    return (*kept, name)


def feed_between(old: DataFrame, new: DataFrame, key: str, but: Collection[str] = ()) -> DataFrame:
    """``change`` and the row, for keys that are not the same in both; ``but``: columns that do not count."""
    told = [c for c in new.columns if c in old.columns and c != key and c not in but]
    o = old.select(F.col(key).alias("_ok"), F.struct(*told).alias("_os"), F.struct(*old.columns).alias("_o"))
    n = new.select(F.col(key).alias("_nk"), F.struct(*told).alias("_ns"), F.struct(*new.columns).alias("_n"))
    kind = (F.when(F.col("_o").isNull(), "insert").when(F.col("_n").isNull(), "delete")
            .when(~F.col("_os").eqNullSafe(F.col("_ns")), "update"))
    both = o.join(n, F.col("_ok") == F.col("_nk"), "full_outer").withColumn("change", kind).where("change is not null")
    return both.select("change", *[
        F.coalesce(F.col(f"_n.{c}"), F.when(F.col("_n").isNull(), F.col(f"_o.{c}"))).alias(c) if c in old.columns
        else F.col(f"_n.{c}").alias(c) for c in new.columns])


def replace(spark: SparkSession, path: str, df: DataFrame, columns: Sequence[str] = (), parts: Collection[str] | None = None,
            sort_cols: Sequence[str] = (), key: str | None = None, but: Collection[str] = (), index: str | None = None,
            placed: DataFrame | None = None, drop: Collection[str] = (), marks: dict | None = None) -> Snapshot:
    """Commit ``df`` as all rows of ``parts`` (``None``: of the table). Other partitions stay as they are, without being read;
    those of ``drop`` go.

    ``key``: log what that changed, by comparing the old and the new rows of these partitions, without the columns ``but``.
    ``index``: keep an index of that column; ``placed`` holds the keys that may have moved (by default all of ``df``'s).
    """
    s, name = load(spark, path), f"c{uuid.uuid4().hex}"
    version, columns = s.version + 1, tuple(columns)
    _write(df, f"{path}/data/commit={name}", columns, sort_cols)
    now = _written_parts(spark, path, name, columns)
    gone = set(s.parts) if parts is None else set(parts) & set(s.parts)
    gone |= set(drop) & set(s.parts)
    if extra := set(now) & set(s.parts) - gone:
        raise ValueError(f"rows outside the partitions to replace: {sorted(extra)[:3]}")
    after = {p: c for p, c in s.parts.items() if p not in gone} | {p: [name] for p in now}
    new = dataclasses.replace(s, version=version, schema=df.schema.json(), columns=columns, parts=after, marks=s.marks | (marks or {}),
                              changed=tuple(sorted(gone | set(now))), log=None, whole=False)
    written = read(spark, path, now, new)
    if key is not None and not s.parts:
        new = dataclasses.replace(new, log=name, whole=True)
    elif key is not None:
        feed = feed_between(read(spark, path, gone, s), written, key, but)
        _write(feed.withColumn("snapshot", F.lit(version).cast("long")), f"{path}/log/commit={name}", ())
        new = dataclasses.replace(new, log=name)
    if index is not None:
        anew = parts is None or not s.index  # also where earlier versions had no index
        rows = (read(spark, path, None, new) if anew else written).select(F.col(index).cast("string").alias("k"), part_of(columns).alias("home"))
        if placed is not None and not anew:
            rows = rows.join(placed.select(F.col(index).cast("string").alias("k")), "k", "left_semi")
        new = dataclasses.replace(new, index=_new_index(spark, path, name, s, version, rows, not anew))
    return commit(spark, path, new)


def append(spark: SparkSession, path: str, df: DataFrame, columns: Sequence[str], source: str, batch: int) -> Snapshot:
    """Commit the rows of a source's batch beside those that are there, once: the last batch of each source is a mark, so a
    batch that is replayed, whatever it holds now, changes nothing."""
    s, name, columns = load(spark, path), f"c{uuid.uuid4().hex}", tuple(columns)
    if s.marks.get(source, -1) >= batch:
        return s
    _write(df, f"{path}/data/commit={name}", columns)
    now = _written_parts(spark, path, name, columns)
    merged = [p for p in now if len(s.parts.get(p, ())) >= MOST_FOLDERS]
    after = s.parts | {p: [*s.parts.get(p, ()), name] for p in now}
    if merged:  # small folders of earlier batches are put together; the log still names this batch's own
        _write(read(spark, path, merged, s), f"{path}/data/commit={name}m", columns)
        after |= {p: [f"{name}m", name] for p in merged}
    return commit(spark, path, dataclasses.replace(
        s, version=s.version + 1, schema=df.schema.json(), columns=columns, parts=after, changed=tuple(now), log=name, whole=True,
        marks=s.marks | {source: batch}))


def fed(spark: SparkSession, path: str, max_versions: int | None = None) -> DataFrame:
    """The versions of a table as a stream: (version), one row for each commit. A consumer reads ``changes`` between the
    least and the greatest version of a batch, so what a commit writes again of older rows is not read again."""
    reader = spark.readStream
    if max_versions:
        reader = reader.option("maxFilesPerTrigger", max_versions)
    found = reader.option("wholetext", True).option("pathGlobFilter", "*.json").text(f"{path}/manifests")
    return found.select(F.get_json_object("value", "$.version").cast("long").alias("version"))


def span(batch: DataFrame) -> tuple[int, int] | None:
    """First and last version of a batch of ``fed``."""
    first, last = batch.agg(F.min("version"), F.max("version")).first()
    return None if first is None else (first, last)


Side = Callable[[str], Column]


def upsert(spark: SparkSession, path: str, source: DataFrame, key: str, columns: Sequence[str], update: Sequence[str] = (),
           when: Callable[[Side, Side], Column] | None = None, on_update: dict[str, Column] | None = None,
           on_insert: dict[str, Column] | None = None, sort_cols: Sequence[str] = (), marks: dict | None = None) -> Snapshot:
    """Merge ``source``, which has the table's columns and one row for each key, by ``key``.

    Matched rows take the ``update`` columns from the source where ``when(src, tgt)`` holds, the rest is inserted; ``on_update`` and
    ``on_insert`` set columns to fixed values. The index says where keys live, so only partitions that hold keys of the source
    are read, and only those in which a row changes are rewritten; inserted rows, and rows that move as a partition column
    is updated, are added as folders beside the old ones.
    """
    s, name = load(spark, path), f"c{uuid.uuid4().hex}"
    version, columns, on_update, on_insert = s.version + 1, tuple(columns), on_update or {}, on_insert or {}
    schema, work = source.schema, f"{path}/work/commit={name}"
    source.write.parquet(f"{work}/source")
    staged = spark.read.schema(schema).parquet(f"{work}/source")
    located = staged.join(homes(spark, path, staged, key, s), key, "left") if s.parts else staged.withColumn("home", F.lit(None).cast("string"))
    located.write.parquet(f"{work}/located")
    located = spark.read.schema(located.schema).parquet(f"{work}/located")

    names = schema.names
    log = located.where("home is null").select(F.lit("insert").alias("change"), "home", *[
        on_insert[c].cast(schema[c].dataType).alias(c) if c in on_insert else F.col(c) for c in names])
    if update:
        here = [r[0] for r in located.where("home is not null").select("home").distinct().collect()]  # a row a partition
        t = read(spark, path, here, s).select(F.struct(*names).alias("t"), F.col(key).alias("_k")) if here else None
        if t is not None:
            news = located.where("home is not null").select(F.struct(*names).alias("s"), F.col(key).alias("_sk"), "home")
            both = t.join(news, F.col("_k") == F.col("_sk"))
            if when is not None:
                both = both.where(F.coalesce(when(lambda c: F.col(f"s.{c}"), lambda c: F.col(f"t.{c}")), F.lit(False)))
            fixed = {c: on_update[c].cast(schema[c].dataType) for c in on_update}
            log = log.unionByName(both.select(F.lit("update").alias("change"), "home", *[
                fixed.get(c, F.col(f"s.{c}" if c in update else f"t.{c}")).alias(c) for c in names]))
    _write(log.withColumn("snapshot", F.lit(version).cast("long")), f"{path}/log/commit={name}", ())
    log = spark.read.schema(T.StructType([*log.schema.fields])).parquet(f"{path}/log/commit={name}")

    touched = log.select("home", part_of(columns).alias("part")).distinct().collect()  # as many as partitions, and moves between them
    updated = {r.home for r in touched if r.home is not None}
    added = {r.part for r in touched} - updated
    rewritten = updated | {p for p in added if len(s.parts.get(p, ())) >= MOST_FOLDERS}
    new = dataclasses.replace(s, version=version, schema=schema.json(), columns=columns, marks=s.marks | (marks or {}), changed=(), log=None,
                              whole=False)
    if touched:
        rows = log.select(*names)
        if rewritten:
            old = read(spark, path, rewritten, s)
            rows = rows.unionByName(old.join(log.where("change = 'update'").select(key), key, "left_anti").select(*names))
        _write(rows, f"{path}/data/commit={name}", columns, sort_cols)
        now = _written_parts(spark, path, name, columns)
        after = {p: c for p, c in s.parts.items() if p not in rewritten}
        after |= {p: [*after.get(p, ()), name] for p in now}
        placed = log.select(F.col(key).cast("string").alias("k"), "home", part_of(columns).alias("part"))
        placed = placed.where("home is null or home <> part").select("k", F.col("part").alias("home"))
        new = dataclasses.replace(new, parts=after, changed=tuple(sorted({*now, *rewritten})), log=name)
        if s.parts and not s.index:  # earlier versions had no index
            placed = read(spark, path, None, new).select(F.col(key).cast("string").alias("k"), part_of(columns).alias("home"))
        new = dataclasses.replace(new, index=_new_index(spark, path, name, s, version, placed, True))
    done = commit(spark, path, new)
    remove(spark, work)
    return done


# ---- catalog -------------------------------------------------------------------------------

def publish(spark: SparkSession, table: str, path: str) -> list[str]:
    """Make the newest version a catalog table. Partitions are added, moved and dropped as the manifests since the version
    published last say; nothing is listed. Returns the partitions touched. For tables written by ``replace``."""
    s = load(spark, path)
    if any(len(c) > 1 for c in s.parts.values()):
        raise ValueError("a catalog partition has one folder; this table has partitions of several")
    kind = lambda f: f"`{f.name}` {f.dataType.simpleString()}"
    if not spark.catalog.tableExists(table):
        by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in s.columns)})" if s.columns else ""
        at = f"{path}/data" if s.columns else f"{path}/data/commit={s.parts[''][0]}"
        spark.sql(f"CREATE TABLE {table} ({', '.join(map(kind, s.struct.fields))}) USING parquet {by} LOCATION '{at}' "
                  "TBLPROPERTIES ('published.version' = '0')")
    last = int({r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get("published.version", 0))
    if last == s.version:
        return []
    if not s.columns:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}/data/commit={s.parts[''][0]}'")
        changed = [""]
    else:
        kept = set(versions(spark, path))
        between = range(last + 1, s.version + 1)
        changed = sorted({p for v in between for p in load(spark, path, v).changed}) if kept.issuperset(between) else None
        if changed is None:  # manifests in between have expired: look at all partitions, once
            changed = sorted({r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} | set(s.parts))
        if changed:
            spec = {p: ", ".join(f"`{c}` = {'NULL' if v is None else repr(v)}" for c, v in part_values(p).items()) for p in changed}
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({spec[p]})" for p in changed))
            if now := [p for p in changed if p in s.parts]:
                spark.sql(f"ALTER TABLE {table} ADD " + " ".join(
                    f"PARTITION ({spec[p]}) LOCATION '{path}/data/commit={s.parts[p][0]}/{p}'" for p in now))
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('published.version' = '{s.version}')")
    spark.catalog.refreshTable(table)
    return changed
