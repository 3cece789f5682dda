"""Helpers that the training-data operators share: checkpoints, row keys, Arrow plumbing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Java pattern of the separators between words: space and U+0009 to U+000D.
WORD_BREAK = r"[\x20\x09-\x0D]+"
#: Groups, such as sources or languages, that are broadcast at most.
FEW_GROUPS = 20_000


def _goes_with(spark: SparkSession, folder: str) -> str:
    """Have a folder deleted when the application ends; works on any file system that Spark writes to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names in spark.checkpoint.dir.

    Where it names none, a temporary one is set in local mode only: executors on other machines could not read it.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return named or current.get()
    if not named and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = named or _goes_with(spark, tempfile.mkdtemp(prefix="checkpoints-"))
    sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder and cut its lineage, so lost executors cost no recomputation.

    Spark removes the files once nothing refers to them if spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def packed(df: DataFrame) -> DataFrame:
    """No more partitions than the cluster has cores: for tables far smaller than the corpus, which would be stored as many tiny files."""
    return df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, deleted when the application ends."""
    return _goes_with(spark, f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")


def removed(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in a scratch folder: compressed, and later reads take only the columns they need."""
    return Stored(df, name).table


class Stored:
    """A table in a scratch folder that can be removed: for the state of a loop.

    A checkpoint keeps its plan's estimated size, which is a product of sizes after joins; through the rounds of a loop that becomes a number
    of millions of digits.  A stored table has the size of its files.
    """

    def __init__(self, df: DataFrame, name: str) -> None:
        spark = df.sparkSession
        self.folder = scratch(spark, name)
        df.write.parquet(self.folder)
        self.table = spark.read.schema(df.schema).parquet(self.folder)

    def replaced(self, df: DataFrame, name: str) -> Stored:
        """Store the next state, then remove this one."""
        new = Stored(df, name)
        removed(df.sparkSession, self.folder)
        return new


def _met(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys, null meeting null; rows' keys are kept."""
    names = [f"_met_{k}" for k in keys]
    other = table.withColumnsRenamed(dict(zip(keys, names, strict=True)))
    met = rows.join(other, reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]), how)
    return met.drop(*names)


def counted_join(rows: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Join rows with counts, a checkpointed table of one row per key and n, the number of rows with that key; keys are not null.

    Rows of a key that holds more than a quarter of an even partition's share are dealt over several partitions, and the key's row in counts is
    sent to each of them.  The list of such keys is broadcast: by arithmetic there are at most four times as many as shuffle partitions,
    and they have at most twice as many parts, whatever the data.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = total // (4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    parts = F.ceil(F.col("n") / most).cast("int")
    hot = F.broadcast(counts.where(F.col("n") > most).select(*keys, parts.alias("_parts")))
    # the number of a row is fixed by its stored partition, so a task that is repeated deals as before
    dealt = rows.join(hot, keys, "left").withColumn("_part", F.when(F.col("_parts").isNotNull(), F.pmod(F.monotonically_increasing_id(), "_parts").cast("int")).otherwise(F.lit(0))).drop("_parts")
    return dealt.join(counts.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))), [*keys, "_part"]).drop("_part")


def group_join(rows: DataFrame, groups: DataFrame, keys: list[str], n: str, few: int = FEW_GROUPS) -> DataFrame:
    """Join rows with a table of groups, one row per key (null meets null), n the number of rows with that key.

    The ``few`` groups with most rows are broadcast, a number that does not grow with the data; those beyond, if there are any, are joined by
    shuffle, as each of them has few rows.
    """
    groups = cut(groups)
    if groups.count() <= few:
        return _met(rows, F.broadcast(groups), keys)
    hot = F.broadcast(cut(groups.orderBy(F.col(n).desc(), *keys).limit(few)))
    return _met(rows, hot, keys).unionByName(_met(_met(rows, hot.select(*keys), keys, "left_anti"), _met(groups, hot.select(*keys), keys, "left_anti"), keys))


def running(df: DataFrame, keys: list[str], amounts: dict[str, str]) -> DataFrame:
    """For each name and column in amounts, add the sum of the column over all rows that come before in the order of keys, over the whole cluster.

    Rows are dealt by ranges of the keys; each range sums its own rows, and the ranges' totals (one row each) are added up.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(df.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()))
    totals = dealt.groupBy("_range").agg(*[F.sum(c).alias(f"_total_{k}") for k, c in amounts.items()])
    earlier, above = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_total_{k}").over(earlier), F.lit(0)).alias(f"_before_{k}") for k in amounts])
    inside = dealt.withColumns({f"_inside_{k}": F.coalesce(F.sum(c).over(above), F.lit(0)) for k, c in amounts.items()})
    met = inside.join(F.broadcast(offsets), "_range")  # one row per shuffle partition
    return met.select(*df.columns, *[(F.col(f"_before_{k}") + F.col(f"_inside_{k}")).cast("bigint").alias(k) for k in amounts])


def words_of(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text, in order; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """128 bits that identify a row's (doc_id, text), never null.  Rows with equal values have equal keys."""
    d, t = F.coalesce(F.col(doc_id).cast("string"), F.lit("\x00")), F.coalesce(F.col(text), F.lit("\x00"))
    return [F.xxhash64(F.lit(1), d, t).alias("key_a"), F.xxhash64(t, F.lit(2), d).alias("key_b")]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that clash with none of df's columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def _named(df: DataFrame, column: str, prefix: str = "") -> Column:
    """The column of that name, whatever its case; null where there is none."""
    kind = next((k for c, k in df.dtypes if c.lower() == column.lower()), None)
    if kind is None:
        return F.lit(None).cast("bigint" if column == "doc_id" else "string").alias(column)
    if column == "doc_id" and kind not in ("bigint", "int", "smallint", "tinyint", "void"):
        raise TypeError(f"doc_id has to be an integer, not {kind}")
    found = F.col(f"{prefix}`{column}`")
    return (found.cast("bigint") if column == "doc_id" else found).alias(column)


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns; a missing one is null, so extra columns never get in the way."""
    return df.select(*[_named(df, c) for c in columns])


def nested(df: DataFrame, *columns: str) -> DataFrame:
    """document, a struct of all of df's columns, and the named columns beside it; clashing names stay inside the struct."""
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("document"))
    return whole.select("document", *[_named(df, c, "document.") for c in columns])


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A batch's texts as Python strings, null as the empty text."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut batches so that decoded texts never fill a worker's memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def arrow_map(df: DataFrame, fn, schema: T.StructType | str) -> DataFrame:
    """mapInArrow of fn over small batches; fn takes and returns a record batch."""

    def over(batches):
        for batch in small_batches(batches):
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(over, schema)


def is_held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the doc_id's text leaves that remainder; a null doc_id counts as held out from learning."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(True))


def ragged_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of values (1-D or rows of 2-D) with the given lengths; empty runs sum to zero."""
    ends = np.cumsum(counts)
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[ends] - total[ends - counts]
