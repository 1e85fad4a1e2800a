"""Executor-side object listing, reading, writing and copying.

Objects are handled by the tasks that hold the rows, through ``pyarrow.fs`` (local files,
HDFS, S3, GCS), never through the driver.  An object's name is its path relative to the root;
names are keys: writing a name again replaces the object, so a replayed micro-batch rewrites
equal bytes.  Any file name is listed and read, also one that begins with ``_`` or ``.``,
which Spark's own file sources skip.
"""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage,
)

SINK_NAME = "lakeframe_objects"
COPY_PART_BYTES = 10 * 1024 * 1024  # Fixed value: upload part size of the object copy.
READ_BATCH_BYTES = 32 * 1024 * 1024
_ASIDE = re.compile(r"\._tmp-[0-9a-f]{32}")  # objects being written aside
_URI = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)?", re.S)


def qualify(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and authority: without them it is in the default file system, as for
    Spark's own readers.  Done on the driver, so that tasks need no Hadoop configuration."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).makeQualified(p).toString()


@functools.cache
def _store(scheme: str, authority: str):
    """One client per store and worker."""
    import pyarrow.fs as pafs

    if scheme == "file":
        return pafs.LocalFileSystem(), ""
    fs, base = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return fs, base.rstrip("/")


def resolve_fs(uri: str):
    """``(filesystem, path)`` of a qualified URI; ``s3a://`` is read as ``s3://``.  The path is
    taken as it is, so it may hold spaces, ``%`` and ``#``."""
    found = _URI.fullmatch(uri)
    if not found:
        raise ValueError(f"not a qualified path: {uri!r}")
    scheme = {"s3a": "s3"}.get(found[1].lower(), found[1].lower())
    fs, base = _store(scheme, found[2] or "")
    return fs, base + (found[3] or "").rstrip("/")


def check_name(name: str) -> str:
    """Object names may contain '/' (prefixes) but no empty, '.' or '..' component."""
    if not name or name.startswith("/") or any(p in ("", ".", "..") for p in name.split("/")):
        raise ValueError(f"bad object name {name!r}")
    return name


def _put(fs, target: str, parts: Iterator[bytes]) -> int:
    """Write one object; on file systems with rename, write aside and move into place, so that
    a failed or doubled attempt never leaves half an object under the real name."""
    parent = target.rsplit("/", 1)[0]
    fs.create_dir(parent, recursive=True)
    whole = fs.type_name in ("s3", "gcs")  # there an object appears when its stream is closed
    at = target if whole else f"{parent}/._tmp-{uuid.uuid4().hex}"
    n = 0
    try:
        with fs.open_output_stream(at) as out:
            for part in parts:
                out.write(part)
                n += len(part)
        if not whole:
            fs.move(at, target)
    except BaseException:
        if not whole:
            _drop(fs, at)
        raise
    return n


def _drop(fs, path: str) -> None:
    try:
        fs.delete_file(path)
    except FileNotFoundError:
        pass


def put_object(fs, base: str, name: str, data: bytes) -> None:
    _put(fs, f"{base}/{check_name(name)}", iter([data]))


class _Written(WriterCommitMessage):
    def __init__(self, count: int, nbytes: int):
        self.count = count
        self.nbytes = nbytes


def _objects_of(batch: pa.RecordBatch, name: str = "name", content: str = "content") -> Iterator[tuple[str, bytes]]:
    for n, c in zip(batch.column(name).to_pylist(), batch.column(content).to_pylist()):
        if n is None or c is None:
            raise ValueError("an object needs a name and content; split off the other rows first")
        yield check_name(n), c


class _Writer:
    """Each object is written aside and moved into place by its task."""

    def __init__(self, options):
        self.options = {k.lower(): v for k, v in options.items()}  # option names have no case

    def write(self, iterator):
        fs, base = resolve_fs(self.options["path"])
        count = nbytes = 0
        for batch in iterator:
            for name, content in _objects_of(batch, self.options.get("namecolumn", "name"), self.options.get("contentcolumn", "content")):
                put_object(fs, base, name, content)
                count, nbytes = count + 1, nbytes + len(content)
        return _Written(count, nbytes)


class _BatchWriter(_Writer, DataSourceArrowWriter):
    pass


class _StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId):
        pass

    def abort(self, messages, batchId):
        pass


class ObjectSink(DataSource):
    """``df.write.format("lakeframe_objects").option("path", root)``, also as a streaming sink: one
    object per row, named by ``nameColumn`` (default ``name``) with bytes from ``contentColumn``
    (default ``content``).  ``path`` must be qualified (:func:`qualify`).  Objects appear one by
    one; :func:`write_objects` lets them appear together."""

    @classmethod
    def name(cls):
        return SINK_NAME

    def writer(self, schema, overwrite):
        return _BatchWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return _StreamWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ObjectSink)


# --- writes in two steps ----------------------------------------------------------------

MANIFEST = "name string, place decimal(38,0), n_bytes long, staged string"
COMPACT_AFTER = 32  # manifests


def _stager(aside: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = resolve_fs(aside)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            names, sizes, staged = [], [], []
            for name, content in _objects_of(batch):
                at = uuid.uuid4().hex
                with fs.open_output_stream(f"{base}/{at}") as out:
                    out.write(content)
                names.append(name), sizes.append(len(content)), staged.append(f"{aside}/{at}")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), batch.column("place"), pa.array(sizes, pa.int64()), pa.array(staged, pa.string())],
                                             names=["name", "place", "n_bytes", "staged"])
    return run


def _publisher(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        fs, base = resolve_fs(root)
        folders: set[str] = set()
        for batch in batches:
            for name, staged in zip(batch.column("name").to_pylist(), batch.column("staged").to_pylist()):
                target, source = f"{base}/{name}", resolve_fs(staged)[1]
                parent = target.rsplit("/", 1)[0]
                if parent not in folders:
                    fs.create_dir(parent, recursive=True)
                    folders.add(parent)
                try:
                    fs.move(source, target)
                except FileNotFoundError:  # an attempt before this one has moved it
                    if fs.get_file_info(target).type != pafs.FileType.File:
                        raise
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])
    return run


def _exists(uri: str) -> bool:
    import pyarrow.fs as pafs

    fs, at = resolve_fs(uri)
    return fs.get_file_info(at).type != pafs.FileType.NotFound


def _delete_folder(uri: str) -> None:
    fs, at = resolve_fs(uri)
    try:
        fs.delete_dir(at)
    except FileNotFoundError:
        pass


def stage_objects(df: DataFrame, aside: str, manifest: str) -> None:
    """First step: tasks write the objects of ``df`` (``name, content, place``) under unique names
    in the folder ``aside`` and one manifest of them all is written.  Its commit is the commit of
    the write: if any task fails there is no manifest, and no object has appeared."""
    spark = df.sparkSession
    aside = qualify(spark, aside)
    _delete_folder(aside)  # of an attempt that did not get to its manifest
    rows = df.select("name", "content", F.col("place").cast("decimal(38,0)").alias("place"))
    try:
        rows.mapInArrow(_stager(aside), MANIFEST).write.mode("overwrite").parquet(manifest)
    except BaseException:
        _delete_folder(aside)
        _delete_folder(qualify(spark, manifest))
        raise


def publish_objects(spark: SparkSession, manifest: str, root: str, aside: str) -> None:
    """Second step: tasks move the objects of a manifest into place.  A replay moves what is left."""
    spark.read.schema(MANIFEST).parquet(manifest).mapInArrow(_publisher(qualify(spark, root)), "n long").write.format("noop").mode("overwrite").save()
    _delete_folder(qualify(spark, aside))


class Places:
    """Which write each object under a root holds: manifests of ``name`` and ``place`` (a number that
    grows with time), one per batch, sorted by name and compacted every ``COMPACT_AFTER``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def manifest(self, folder: str) -> str:
        return f"{self.path}/batches/{folder}"

    def committed(self, folder: str) -> bool:
        return _exists(qualify(self.spark, f"{self.manifest(folder)}/_SUCCESS"))

    def _folders(self, kind: str) -> list[str]:
        """Committed manifests, oldest first."""
        import pyarrow.fs as pafs

        fs, base = resolve_fs(qualify(self.spark, f"{self.path}/{kind}"))
        found = fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        done = sorted((i.mtime, i.path) for i in found if i.base_name == "_SUCCESS")
        return [f"{self.path}/{kind}/" + path[len(base):].strip("/").rsplit("/", 1)[0] for _, path in done]

    def known(self) -> DataFrame:
        """``name, known_place`` of every object written so far."""
        paths = self._folders("compacted")[-1:] + self._folders("batches")
        if not paths:
            return self.spark.createDataFrame([], "name string, known_place decimal(38,0)")
        rows = self.spark.read.schema("name string, place decimal(38,0)").parquet(*paths)
        return rows.groupBy("name").agg(F.max("place").alias("known_place"))

    def compact(self) -> None:
        """Fold all manifests into one, sorted by name.  For between two batches: a manifest must
        not go while its batch may be replayed.  An interrupted run changes nothing."""
        old = self._folders("batches")
        if len(old) < COMPACT_AFTER:
            return
        earlier = self._folders("compacted")
        target = f"{self.path}/compacted/{uuid.uuid4().hex}"
        self.known().withColumnRenamed("known_place", "place").repartitionByRange("name").sortWithinPartitions("name").write.parquet(target)
        for folder in old + earlier:
            _delete_folder(qualify(self.spark, folder))


def write_objects(df: DataFrame, root: str, name: str = "name", content: str = "content",
                  place: str | None = None, places: Places | None = None, folder: str | None = None) -> None:
    """Batch object write (K3/K10), one object per row, from the executors, in two steps: all
    objects are written aside, then moved into place.  A row without a name or content, or any
    other failure of the first step, leaves the root as it was.

    With ``place`` (a number that grows with time) and ``places`` an object keeps its latest write
    whatever order the batches come in; ``folder`` names the batch, and writing it again only
    finishes what the first attempt has left."""
    spark = df.sparkSession
    rows = df.select(F.col(name).alias("name"), F.col(content).alias("content"),
                     (F.col(place) if place else F.lit(None)).cast("decimal(38,0)").alias("place"))
    folder = folder or uuid.uuid4().hex
    aside = f"{root.rstrip('/')}.staged/{folder}"
    manifest = places.manifest(folder) if places else f"{aside}.manifest"
    if places is None:
        stage_objects(rows, aside, manifest)
    elif not places.committed(folder):
        places.compact()
        newer = rows.join(places.known(), "name", "left").where("known_place IS NULL OR place > known_place")
        stage_objects(newer, aside, manifest)
    publish_objects(spark, manifest, root, aside)
    if places is None:
        _delete_folder(qualify(spark, manifest))


LISTING = "path string, name string, length long, modificationTime timestamp"


def _lister(root: str, deep: bool, recursive: bool):
    """Listing of folders: (folder) -> entries.  ``deep``: everything below; else one level, with
    folders as entries without a length if ``recursive``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        for batch in batches:
            for folder in batch.column("path").to_pylist():
                fs, base = resolve_fs(folder)
                top = resolve_fs(root)[1]
                prefix = root.rstrip("/")
                found = [i for i in fs.get_file_info(pafs.FileSelector(base, recursive=deep)) if not _ASIDE.fullmatch(i.base_name)]
                if not (recursive and not deep):
                    found = [i for i in found if i.type == pafs.FileType.File]
                names = [i.path[len(top):].lstrip("/") for i in found]
                for at in range(0, len(found), 10_000):
                    part, own = found[at:at + 10_000], names[at:at + 10_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f"{prefix}/{n}" for n in own], pa.string()), pa.array(own, pa.string()),
                        pa.array([i.size if i.type == pafs.FileType.File else None for i in part], pa.int64()),
                        pa.array([i.mtime for i in part], pa.timestamp("us", "UTC"))], names=["path", "name", "length", "modificationTime"])
    return run


def list_objects(spark: SparkSession, root: str, recursive: bool = False) -> DataFrame:
    """Files under ``root`` (S10, S11, F4): ``path, name, length, modificationTime``; the name is
    the path relative to ``root``.  A folder is listed by one task; with ``recursive`` each
    folder directly under ``root`` is listed, with all below it, by a task of its own."""
    root = qualify(spark, root)
    top = spark.createDataFrame([(root,)], "path string")
    if not recursive:
        return top.mapInArrow(_lister(root, False, False), LISTING)
    level = top.mapInArrow(_lister(root, False, True), LISTING)
    folders = level.where("length IS NULL").select("path").repartition(_tasks(spark))
    return level.where("length IS NOT NULL").unionByName(folders.mapInArrow(_lister(root, True, True), LISTING))


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        start, held, size = 0, [], 0
        for i, path in enumerate(batch.column("path").to_pylist()):
            fs, at = resolve_fs(path)
            with fs.open_input_stream(at) as f:
                held.append(f.read())
            size += len(held[-1])
            if size >= READ_BATCH_BYTES or i == batch.num_rows - 1:
                part = batch.slice(start, len(held))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())], names=[*part.schema.names, "content"])
                start, held, size = i + 1, [], 0


def with_content(listing: DataFrame, tasks: int | None = None) -> DataFrame:
    """Adds the ``content`` of each listed ``path``, read by the executors (S12).  Only the listing is
    dealt out to tasks, so join and filter it first: bytes are read in the last stage and never
    shuffled here."""
    dealt = listing.repartition(tasks or _tasks(listing.sparkSession))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in listing.schema.fields)
    return dealt.mapInArrow(_read_batches, f"{columns}, content binary")


def read_objects(spark: SparkSession, root: str, recursive: bool = False) -> DataFrame:
    """Object bytes read by the executors (S12): ``path, name, length, content``."""
    found = with_content(list_objects(spark, root, recursive).select("path", "name"))
    return found.select("path", "name", F.octet_length("content").cast("long").alias("length"), "content")


COPY_SCHEMA = "name string, n_bytes long, status string, error string"


def _copier(dest: str, part_bytes: int):
    def copy_one(path: str, name: str) -> int:
        sfs, source = resolve_fs(path)
        dfs, base = resolve_fs(dest)
        with sfs.open_input_stream(source) as src:
            return _put(dfs, f"{base}/{check_name(name)}", iter(lambda: src.read(part_bytes), b""))

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, name, other in zip(pdf["path"], pdf["name"], pdf["other"]):
                if other is not None:
                    out.append((name, None, "failed", f"the name is taken by {other}"))
                    continue
                try:
                    out.append((name, copy_one(path, name), "ok", None))
                except Exception as e:  # noqa: BLE001 - one failed object must not stop the run
                    out.append((name, None, "failed", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["name", "n_bytes", "status", "error"])
    return copy


def copy_objects(listing: DataFrame, dest: str, status_path: str, tasks: int | None = None,
                 part_bytes: int = COPY_PART_BYTES) -> DataFrame:
    """Copy every listed object to ``dest`` and land a status per object (K12, R3); returns the
    landed status table.  The copy runs once, in this call.

    ``listing`` needs ``path`` (qualified) and ``name``.  Copies run in tasks, streamed in parts
    of ``part_bytes``, so an object is never held whole in memory.  A failure is reported in
    its row, whole, and does not stop the others; of paths listed under one name the first
    by path is copied and the others are reported as failed."""
    spark = listing.sparkSession
    same = Window.partitionBy("name").orderBy("path")
    src = listing.select("path", "name").withColumn("first", F.first("path").over(same)).withColumn("nth", F.row_number().over(same))
    src = src.select("path", "name", F.when(F.col("nth") > 1, F.col("first")).alias("other")).repartition(tasks or _tasks(spark))
    src.mapInPandas(_copier(qualify(spark, dest), part_bytes), COPY_SCHEMA).write.parquet(status_path)
    return spark.read.schema(COPY_SCHEMA).parquet(status_path)


def copy_new_objects(listing: DataFrame, dest: str, ledger: str, run: str) -> DataFrame:
    """The daily copy (R3, S10, K12): copies the listed objects that no earlier run has copied as they
    are now (by name, size and modification time) and returns this run's rows of the ledger,
    ``name, length, modificationTime, n_bytes, status, error``.

    The ledger at ``ledger`` is a table partitioned by run, and a run's part appears when all its
    copies have ended.  What failed is tried again by the next run, and so is a run that broke
    off; a run that is there already is not made again."""
    spark = listing.sparkSession
    schema = "name string, length long, modificationTime timestamp, n_bytes long, status string, error string"
    mine = f"{ledger.rstrip('/')}/run={run}"
    if not _exists(qualify(spark, f"{mine}/_SUCCESS")):
        objects = listing.select("path", "name", "length", "modificationTime")
        if _exists(qualify(spark, ledger)):
            done = spark.read.schema(schema).parquet(ledger).where("status = 'ok'")
            objects = objects.join(done, ["name", "length", "modificationTime"], "left_anti")
        aside = f"{ledger.rstrip('/')}.{uuid.uuid4().hex}"
        objects.write.parquet(f"{aside}/listing")  # the listing of this run, read once
        objects = spark.read.parquet(f"{aside}/listing")
        status = copy_objects(objects, dest, f"{aside}/status").dropDuplicates(["name", "status"])
        rows = objects.select("name", "length", "modificationTime").join(status, "name")
        rows.select("name", "length", "modificationTime", "n_bytes", "status", "error").write.mode("overwrite").parquet(mine)
        _delete_folder(qualify(spark, aside))
    return spark.read.schema(schema).parquet(mine)
