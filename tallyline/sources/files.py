"""Which file of a folder to read, and where results go."""

from __future__ import annotations

import contextlib
import posixpath
import re
import tempfile
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import workbooks

STAMP = r"(\d{8}_\d{6})"


#: What the names of results, which aren't reports, contain.
RESULTS = ("COMPARE_RESULT", "AUTOMATION_SUMMARY")


def listed(spark: SparkSession, folder: str, pattern: str = "*.xlsx", code: str = "", without: tuple[str, ...] = ()) -> DataFrame:
    """(path, name, stamp, modified) of a folder's files; lock files are left out and no content is read. stamp: the last yyyyMMdd_HHmmss in the name.

    Case aside, the name must contain code and none of `without`.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", F.col("modificationTime").alias("modified"))
    named = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).where("not startswith(name, '~$')")
    named = named.where(F.contains(F.upper("name"), F.lit(code.upper())))
    for part in without:
        named = named.where(~F.contains(F.upper("name"), F.lit(part.upper())))
    stamps = F.regexp_extract_all("name", F.lit(STAMP), F.lit(1))
    return named.select("path", "name", F.get(stamps, F.size(stamps) - 1).alias("stamp"), "modified")


def newest_report(spark: SparkSession, folder: str, code: str, by_name: bool = False) -> str:
    """The newest workbook of a report: its name holds the report's code and isn't that of a result."""
    return newest(listed(spark, folder, code=code, without=RESULTS), by_name)


def numeric_name(name: Column) -> Column:
    """A name's order: case aside, numbers in it by their value, so that report 10 comes after report 9."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"\d+|\D+"), F.lit(0))
    digits = lambda x: F.regexp_replace(x, "^0+(?=.)", "")
    # A number is its length, then its digits; no name holds 10^9 digits.
    return F.transform(parts, lambda x: F.when(x.rlike(r"^\d"), F.concat(F.lit("0"), F.lpad(F.length(digits(x)).cast("string"), 9, "0"), digits(x))).otherwise(F.concat(F.lit("1"), x)))


def newest(files: DataFrame, by_name: bool = True) -> str:
    """The path of the newest file, by the stamp in its name, then its time, then its name; raises if there is none."""
    order = [F.desc_nulls_last("stamp")] * by_name + [F.desc("modified"), F.desc(numeric_name(F.col("name"))), F.desc("name")]
    if not (top := files.orderBy(*order).limit(1).collect()):
        raise FileNotFoundError("no such file")
    return top[0].path


def report_code(name: Column, codes: list[str]) -> Column:
    """The first of the codes that the upper-cased name contains; null if none."""
    return F.coalesce(*(F.when(F.contains(F.upper(name), F.lit(c)), c) for c in codes))


def _plain(path: str) -> list[str]:
    """The parts of a path, without scheme and host, `.` and `..`."""
    return posixpath.normpath(re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", path)).strip("/").split("/")


def overlap(one: str, other: str) -> bool:
    """Whether two paths are the same or one lies within the other, however they are written."""
    a, b = _plain(one), _plain(other)
    return a[: len(b)] == b or b[: len(a)] == a


def _at(spark: SparkSession, path: str):
    """The path's file system, and the path, as Spark sees them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the session names it for checkpoints; a session on one machine may go without one, and gets a temporary one."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tallyline-"))
    return context.getCheckpointDir().rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has; what is written there goes when the application ends."""
    path = f"{shared_folder(spark)}/tallyline-{name}-{uuid.uuid4().hex}"
    files, where = _at(spark, path)
    files.deleteOnExit(where)
    return path


def free_names(spark: SparkSession, path: str, most: int = 9_999) -> Iterator[str]:
    """The path, path_01, path_02, ... without those that exist; the folder is listed once. Raises after the last."""
    files, where = _at(spark, path)
    folder = where.getParent()
    taken = {s.getPath().getName() for s in files.listStatus(folder)} if files.exists(folder) else set()
    for name in (path, *(f"{path}_{i:02d}" for i in range(1, most + 1))):
        if posixpath.basename(name) not in taken:
            yield name
    raise FileExistsError(f"{path} and {most} more names are taken")


def free_name(spark: SparkSession, path: str, most: int = 9_999) -> str:
    """The path, or the first of path_01, path_02, ... that doesn't exist; raises if all do. Another one may take it in the meantime; claimed() holds it."""
    return next(free_names(spark, path, most))


def _made(spark: SparkSession, path: str) -> bool:
    """Whether an empty file could be made, by one step of its store, where there was none."""
    files, where = _at(spark, path)
    files.mkdirs(where.getParent())
    try:
        if files.getUri().getScheme() == "file":
            return spark._jvm.java.io.File(where.toUri().getPath()).createNewFile()
        files.create(where, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


@contextlib.contextmanager
def claimed(spark: SparkSession, path: str, most: int = 9_999) -> Iterator[str]:
    """A free name as of free_names(), held against other writers while it is written: who makes the file _claim-<name> beside it first has it. The file goes at the end; one that a writer that died has left keeps its name from use."""
    for name in free_names(spark, path, most):
        folder, last = posixpath.split(name)
        claim = f"{folder}/_claim-{last}"
        if not _made(spark, claim):
            continue
        try:
            # Who had the name before may have written it since the folder was listed.
            if not _at(spark, name)[0].exists(_at(spark, name)[1]):
                yield name
                return
        finally:
            _at(spark, claim)[0].delete(_at(spark, claim)[1], False)


def publish(results: DataFrame, base: str, report: str, run_id: str, kind: str = "parquet", inputs: tuple[str, ...] = (), another_name: bool = False) -> str:
    """Write results under a folder of their own, which must not exist nor overlap with an input; Spark's commit makes it appear whole. With another_name a taken folder gets the next free number instead, which no other writer gets. kind: a format of Spark's, or `sheet` for workbooks."""
    path = f"{base.rstrip('/')}/report={report}/run={run_id}"
    if hit := [i for i in inputs if overlap(path, i)]:
        raise ValueError(f"{path} is an input, or lies in or around one: {hit[0]}")
    if not another_name:
        return _written(results, path, kind)
    with claimed(results.sparkSession, path) as name:
        return _written(results, name, kind)


def _written(results: DataFrame, path: str, kind: str) -> str:
    if kind == workbooks.SheetSource.name():
        workbooks.register(results.sparkSession)
        # The format itself refuses a folder that exists.
        results.write.mode("append").format(kind).save(path)
    else:
        results.write.mode("errorifexists").format(kind).save(path)
    return path
