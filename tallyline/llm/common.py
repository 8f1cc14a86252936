"""Helpers that several operators share: reading, shared tables, Arrow mapping, size checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: words are what is left between these characters.
WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"

#: A side of a join is broadcast only after its rows were counted and are at most so many (of a few numbers each).
BROADCAST_ROWS = 1_000_000

#: A key is hot from so many rows on, and beyond LEAST_HOT * MOST_HOT rows from their MOST_HOT-th part on.
LEAST_HOT, MOST_HOT = 500, 200_000

#: Values of up to so many rows' keys, of a few numbers each, are broadcast whole.
FEW_ROWS = 200_000

#: Arrow batches are cut to about so many characters before Python strings are made from them.
SLICE_CHARS = 4_000_000

#: Rows of an Arrow batch at most, as whole texts are sent to workers.
ARROW_ROWS = 1_000

#: Batches of arrays are cut to about so many items before numpy works on them.
SLICE_ITEMS = 400_000

ARROW = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(), T.StringType(): pa.string(), T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary(), T.ArrayType(T.LongType()): pa.list_(pa.int64())}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """The rows that no model may learn from: crc32 of the id as text leaves 2 when divided by 4. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE, -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for each row, however often body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    Where the session names none, a temporary one serves a session on one machine; any other raises, as
    executors would write to disks that the driver can't read.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tallyline-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _location(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


#: Tables in the shared folder that weren't forgotten yet, in the order of their making.
_KEPT: list[DataFrame] = []


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: a cut in the lineage that outlives executors.

    Lazy results may read it, so it stays until it is forgotten, at the latest until the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallyline-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, where = _location(spark, path)
    files.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._tallyline_path = path
    _KEPT.append(out)
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables made by keep() once nothing lazy depends on them."""
    gone = {t._tallyline_path for t in tables}
    for t in tables:
        files, where = _location(t.sparkSession, t._tallyline_path)
        files.delete(where, True)
    _KEPT[:] = [t for t in _KEPT if t._tallyline_path not in gone]


def kept() -> list[DataFrame]:
    """The tables that keep() made and that weren't forgotten, in order."""
    return list(_KEPT)


def small(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it was counted to be within the bound, else df: the join then shuffles."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def hot_rows(total: int) -> int:
    """Rows of one key beyond which it is hot: of total rows at most MOST_HOT keys have so many."""
    return max(LEAST_HOT, total // MOST_HOT)


def looked_up(rows: DataFrame, values: DataFrame, key: str | list[str], total: int, count: str = "_m") -> DataFrame:
    """rows joined with values, which has one row for each key and the number of rows that have it in `count`; total: all rows, at least.

    A hot key's rows would all go to one task. There are MOST_HOT such keys at most, so their values are
    broadcast and their rows stay where they are; all others are shuffled. Of FEW_ROWS rows at most all
    values, which are no more, are broadcast.
    """
    keys = [key] if isinstance(key, str) else key
    if total <= FEW_ROWS:
        return rows.join(F.broadcast(values), keys)
    hot, rest = values.where(F.col(count) > hot_rows(total)), values.where(F.col(count) <= hot_rows(total))
    here = rows.join(F.broadcast(hot), keys)
    return rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys).unionByName(here)


#: Equal rows that one row of the table of counts makes at once.
COPIES = 1_000


def told_apart(counted: DataFrame, count: str, into: str, most: int) -> DataFrame:
    """Each row of a table of counts as often as `count` says, its copies numbered from 0 in `into`; most: the highest count.

    So equal rows of an input are told apart without a place in the input; those that are very many are
    made by many tasks.
    """
    rest = [F.col(f"`{c}`") for c in counted.columns if c != count]
    if most <= 1:
        return counted.select(*rest, F.lit(0).cast("long").alias(into))
    few = counted.where(F.col(count) <= COPIES).select(*rest, F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1)).alias(into))
    if most <= COPIES:
        return few
    blocks = counted.where(F.col(count) > COPIES).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(`{count}` - 1) div {COPIES}"))).alias("_from"))
    first = F.col("_from") * COPIES
    many = blocks.repartition("_from").select(*rest, F.explode(F.sequence(first, F.least(F.col(count), first + COPIES) - 1)).alias(into))
    return few.unionByName(many)


def smaller_batches(spark: SparkSession) -> None:
    """Lower the session's rows to an Arrow batch to ARROW_ROWS, if it has more: a batch is held whole by a task and by its worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, ARROW_ROWS)


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about SLICE_CHARS bytes of text, one row at least."""
    n = batch.num_rows
    if not n:
        return
    each = max(1, int(n * SLICE_CHARS / max(1, batch.column(text).nbytes)))
    for start in range(0, n, each):
        yield batch.slice(start, each)


def list_slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of SLICE_ITEMS items of its array column, one row at least; the column's values stay whole, its offsets are the slice's."""
    ends, start = batch.column(at).offsets.to_numpy(), 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + SLICE_ITEMS, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def map_text(df: DataFrame, make: Callable[[], Callable[[list], list]], fields: list[tuple[str, T.DataType]], text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For each row the carried columns and those that make()(texts) returns; make runs once in a worker's task."""
    schema = T.StructType([*(df.schema[c] for c in carry), *(T.StructField(n, t) for n, t in fields)])
    kinds, names = [ARROW[t] for _, t in fields], schema.names
    sent = [*carry] if text in carry else [*carry, text]
    at = sent.index(text)

    def run(batches):
        f = make()
        for batch in batches:
            for part in slices(batch, at):
                made = f(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(carry))), *(pa.array(c, k) for c, k in zip(made, kinds, strict=True))], names=names)

    smaller_batches(df.sparkSession)
    return df.select(*sent).mapInArrow(run, schema)


def boxed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The text, and all other columns in one struct `_row`, so that their names can't clash with new columns."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("_row"), text)


def unboxed(df: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    return df.select(*(F.col(text) if c == text else F.col("_row")[c].alias(c) for c in columns))
