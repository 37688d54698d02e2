"""File operations on whatever file system the cluster uses, through Hadoop."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

SCRATCH = "ledgerloom"


def _resolve(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    fs, path = _resolve(spark, location)
    return fs.exists(path)


def holds_data(spark: SparkSession, location: str) -> bool:
    """Whether the folder has a file that Spark would read, in it or in a partition folder."""
    fs, path = _resolve(spark, location)
    if not fs.exists(path):
        return False
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith((".", "_")) and "=" not in name:
            continue
        if status.isFile() or holds_data(spark, status.getPath().toString()):
            return True
    return False


def delete(spark: SparkSession, location: str) -> None:
    fs, path = _resolve(spark, location)
    fs.delete(path, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, path = _resolve(spark, source)
    _, target_path = _resolve(spark, target)
    fs.mkdirs(target_path.getParent())
    if not fs.rename(path, target_path):
        raise OSError(f"could not rename {source} to {target}")


def children(spark: SparkSession, location: str) -> list[str]:
    """Names in a folder, none if it isn't there."""
    fs, path = _resolve(spark, location)
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def read_text(spark: SparkSession, location: str) -> str | None:
    """A small file, or None if it isn't there."""
    fs, path = _resolve(spark, location)
    fs = _without_checksums(fs)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, location: str, text: str, rename: bool = True) -> None:
    """Replace a small file in one step, so that readers find the old or the new content.

    With ``rename`` the text is written beside it and renamed over it, which HDFS and local
    file systems do at once. An object store does the same with a plain overwrite, as an object
    appears when its upload is complete, but copies to rename; there turn it off.
    """
    fs, path = _resolve(spark, location)
    fs = _without_checksums(fs)
    target = path
    if rename:
        target = spark._jvm.org.apache.hadoop.fs.Path(sibling(location, "put"))
    try:
        stream = fs.create(target, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if rename:
            _rename_over(spark, fs, target, path)
    except Exception:
        if rename:
            fs.delete(target, False)
        raise


def _without_checksums(fs):
    """A local file system keeps checksums in a second file, which can't change at the same time."""
    return fs.getRawFileSystem() if fs.getClass().getSimpleName() == "LocalFileSystem" else fs


def _rename_over(spark: SparkSession, fs, source, target) -> None:
    if fs.getUri().getScheme() == "file":
        os.replace(source.toUri().getPath(), target.toUri().getPath())  # Hadoop's own doesn't overwrite
        return
    hadoop = spark._jvm.org.apache.hadoop.fs
    overwrite = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, target, overwrite)


def listing(spark: SparkSession, location: str) -> list[tuple[str, int, int]]:
    """Name, size and time of change of the file, or of all files below the folder; none if absent."""
    fs, path = _resolve(spark, location)
    if not fs.exists(path):
        return []
    found = []
    files = fs.listFiles(path, True)
    while files.hasNext():
        file = files.next()
        found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return sorted(found)


def newest_change(spark: SparkSession, location: str) -> int:
    """When the folder or any file below it last changed, in milliseconds."""
    fs, path = _resolve(spark, location)
    newest = fs.getFileStatus(path).getModificationTime()
    files = fs.listFiles(path, True)
    while files.hasNext():
        newest = max(newest, files.next().getModificationTime())
    return newest


def sibling(location: str, role: str) -> str:
    """A fresh hidden name next to ``location``; Spark never lists it as data."""
    parent, _, name = location.rstrip("/").rpartition("/")
    hidden = f"_{role}-{name}-{uuid.uuid4().hex}"
    return f"{parent}/{hidden}" if parent else hidden


def scratch_root(spark: SparkSession) -> str:
    """Where scratch tables go: below ``spark.checkpoint.dir``, which all executors share.

    Where that is unset, below Hadoop's own folder for temporary data on the default file
    system. On a cluster whose default file system is a local one, the setting is needed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        hadoop = spark._jsc.hadoopConfiguration()
        local = hadoop.get("fs.defaultFS", "file:///").startswith("file:")
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        fs, path = _resolve(spark, hadoop.get("hadoop.tmp.dir"))
        root = fs.makeQualified(path).toString()
    return f"{root.rstrip('/')}/{SCRATCH}"


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``scratch_root``.

    A frame that is returned over tables in it still needs them; whoever has taken the
    rows deletes the folder, or all of this application's with ``clear_scratch``.
    """
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application."""
    delete(spark, f"{scratch_root(spark)}/{spark.sparkContext.applicationId}")
