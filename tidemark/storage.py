"""Folders on the cluster's file system, reached through Spark's own Hadoop client."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from itertools import batched
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# File system calls under way at once, and names handled at a time.
THREADS = 16
PAGE = 10_000

_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def folder_names(spark: SparkSession, root: str) -> Iterator[str]:
    """Names of the folders directly below ``root``, from one listing, page by page.

    A listing that fails raises: it must never look like an empty folder.
    """
    listing = _file_system(spark, root).listStatusIterator(_path(spark, root))
    while listing.hasNext():
        entry = listing.next()
        if entry.isDirectory():
            yield entry.getPath().getName()


def file_paths(spark: SparkSession, root: str) -> Iterator[str]:
    """Paths, relative to ``root``, of the data files anywhere below it."""
    whole = _file_system(spark, root).makeQualified(_path(spark, root)).toString().rstrip("/")
    listing = _file_system(spark, root).listFiles(_path(spark, root), True)
    while listing.hasNext():
        path = listing.next().getPath()
        if not path.getName().startswith(("_", ".")):
            yield path.toString().removeprefix(whole).lstrip("/")


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder in one step; False if ``target`` is there already, which then stays."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(
        _path(spark, source).toUri(), spark._jsc.hadoopConfiguration()
    ) if _path(spark, source).toUri().getScheme() else hadoop.FileContext.getFileContext(
        spark._jsc.hadoopConfiguration()
    )
    if files.util().exists(_path(spark, target)):
        return False
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        files.rename(_path(spark, source), _path(spark, target), options)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getSimpleName():
            return False
        raise
    return True


def move_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to a path that is free; False if there is no ``source``."""
    files = _file_system(spark, source)
    if not files.exists(_path(spark, source)):
        return False
    if files.exists(_path(spark, target)):
        raise FileExistsError(target)
    make_folder(spark, target.rsplit("/", 1)[0])
    if not files.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not move {source} to {target}")
    return True


def listed(spark: SparkSession, names: Iterable[str], name: str) -> DataFrame:
    """``names`` as a stored table with the column ``name``, written page by page."""
    schema, folder, any_page = f"{name} string", new_folder(spark, "listing"), False
    for page in batched(names, PAGE):
        rows = spark.createDataFrame([(value,) for value in page], schema)
        rows.write.mode("append").parquet(folder)
        any_page = True
    if not any_page:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def for_each(action: Callable[[str], object], names: Iterable[str]) -> None:
    """Run ``action`` on all names, THREADS at a time; an error is raised after its page."""
    with ThreadPoolExecutor(THREADS) as pool:
        for page in batched(names, PAGE):
            list(pool.map(action, page))


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``, which may be a pattern; 0 if there is nothing."""
    files = _file_system(spark, path)
    found = files.globStatus(_path(spark, path)) or ()
    return sum(files.getContentSummary(entry.getPath()).getLength() for entry in found)


def make_folder(spark: SparkSession, path: str) -> None:
    if not _file_system(spark, path).mkdirs(_path(spark, path)):
        raise OSError(f"could not create {path}")


def write_as_file(df: DataFrame, target: str) -> None:
    """Write a one-row frame as the single Parquet file ``target``, replacing an older one.

    It is written to a hidden folder beside and moved, so writers to one folder do not meet
    and a reader sees the whole file or none.
    """
    spark, (folder, _, name) = df.sparkSession, target.rpartition("/")
    beside = f"{folder}/_{name}-{uuid.uuid4().hex}"
    df.coalesce(1).write.parquet(beside)
    files = _file_system(spark, beside)
    (part,) = files.globStatus(_path(spark, f"{beside}/part-*.parquet"))
    remove_folder(spark, target)
    if not files.rename(part.getPath(), _path(spark, target)):
        raise OSError(f"could not write {target}")
    remove_folder(spark, beside)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with its content, or a file; False if there was none."""
    files = _file_system(spark, path)
    if not files.exists(_path(spark, path)):
        return False
    if not files.delete(_path(spark, path), True):
        raise OSError(f"could not delete {path}")
    return True


def input_files(df: DataFrame) -> list[str]:
    """Paths of the files ``df`` reads, as they were listed when it was opened."""
    return [unquote(file) for file in df.inputFiles()]


def _target(spark: SparkSession, path: str, folder: str) -> str:
    return f"{folder.rstrip('/')}/{_path(spark, path).getName()}"


def check_absent(spark: SparkSession, paths: list[str], folder: str) -> None:
    """Raise unless all ``paths`` can go below ``folder`` under names of their own."""
    names = {path.rsplit("/", 1)[-1] for path in paths}
    if len(names) < len(paths):
        raise FileExistsError(f"files of the same name can not all go to {folder}")
    if not exists(spark, folder):
        return
    listing = _file_system(spark, folder).listStatusIterator(_path(spark, folder))
    while listing.hasNext():
        name = listing.next().getPath().getName()
        if name in names:
            raise FileExistsError(f"{folder}/{name} is there already")


def move_into(spark: SparkSession, paths: list[str], folder: str) -> None:
    """Move files below ``folder``; raises unless every move took place."""
    check_absent(spark, paths, folder)
    make_folder(spark, folder)

    def move(path: str) -> None:
        files, target = _file_system(spark, path), _target(spark, path, folder)
        if not files.exists(_path(spark, path)):
            raise FileNotFoundError(path)
        if not files.rename(_path(spark, path), _path(spark, target)):
            raise OSError(f"could not move {path} to {target}")

    for_each(move, paths)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a new, unused folder below the shared root."""
    path = f"{shared_root(spark)}/tidemark/{purpose}-{uuid.uuid4().hex}"
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return path


@contextmanager
def passing_folders(spark: SparkSession) -> Iterator[None]:
    """Remove at the end, after a failure too, what `new_folder` has named inside.

    For steps whose result is stored elsewhere before the end. Folders named by other threads
    stay.
    """
    token = _passing.set([])
    try:
        yield
    finally:
        names = _passing.get()
        _passing.reset(token)
        for_each(lambda path: remove_folder(spark, path), names)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` as Parquet and read it back.

    Cuts the lineage with a table that outlives lost executors, and makes every later pass
    columnar: narrow passes read narrow columns, counts read footers.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
