"""Sharding by extendible hashing.

A row's hash is 60 bits of a digest of its id and text.  A directory is indexed by leading hash bits; only a bucket over the byte limit is split, on
its next bit, until all fit.  Rows are first counted into cells of as many bits as an even split would need and a few more, so
splitting works on cells rather than rows; cells that are still too large are counted again with more bits, alone.

A bucket that cannot be split further (equal hashes, or one row over the limit) becomes a chain of pages in order of id, each within
the limit unless it holds a single row.  Its rows are put in order over the whole cluster, so many repeats of one row are no large group.

Defined results: null text has no bytes; rows with null ids are sharded by their text; repeated rows share a hash and so a bucket or its
pages; an empty table gives an empty table; ``write`` keeps all columns, whatever they are called.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import counted_join, cut, fresh, narrow, nested, removed, running, scratch

LIMIT = 1 << 20
HASH_BITS = 60
#: Bits of a cell beyond those of an even split, and bits added for cells that do not fit.
SPARE, MORE = 5, 8


def hash_of(doc_id: Column, text: Column) -> Column:
    """60 leading bits of md5 over the id's and the text's digests, as a non-negative long."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _lead(bits: int) -> Column:
    return F.shiftright("hash", HASH_BITS - bits)


def _leaves(cells: DataFrame, depth: int, least: int, limit: int) -> DataFrame:
    """cell, n, and depth and bytes of the bucket it falls in, between `least` and `depth` bits; a cell that never fits has depth null."""
    node = F.expr(f"shiftright(cell, {depth} - bits)").alias("node")
    levels = lambda lowest: cells.select("cell", "bytes", F.explode(F.sequence(F.lit(lowest), F.lit(depth))).alias("bits"))
    sums = cut(levels(least).groupBy("bits", node).agg(F.sum("bytes").alias("bucket_bytes")))
    # a bucket fits while its parent, which has two children at most, does not
    split = sums.where(F.col("bucket_bytes") > limit).select((F.col("bits") + 1).alias("bits"), F.col("node").alias("parent"))
    fit = sums.where(F.col("bucket_bytes") <= limit).withColumn("parent", F.expr("shiftright(node, 1)"))
    buckets = cut(fit.where(F.col("bits") == least).unionByName(fit.where(F.col("bits") > least).join(split, ["bits", "parent"], "left_semi").select(*fit.columns)).drop("parent"))
    # cells look for their bucket only at levels that have one; the levels above, of few and large nodes, are not shuffled
    lowest = buckets.agg(F.min("bits")).first()[0]
    found = levels(depth if lowest is None else lowest).select("cell", "bits", node).join(buckets, ["bits", "node"]).select("cell", "bits", "bucket_bytes")
    return cells.join(found, "cell", "left").select("cell", "n", "bits", "bucket_bytes")


def _sized(rows: DataFrame) -> DataFrame:
    """Replace text by its bytes and the row's hash, and number the rows."""
    kept = [c for c in rows.columns if c != "text"]
    return rows.select(*kept, F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), hash_of(F.col("doc_id"), F.col("text")).alias("hash"), F.monotonically_increasing_id().alias("uid"))


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """Add shard, bits and shard_bytes to stored rows of doc_id, n_bytes, hash and uid."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(HASH_BITS, max(1, math.ceil(math.log2(max(2, total / limit))) + SPARE))
    least, left, done = 0, rows, None
    while True:
        cells = left.groupBy(_lead(depth).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
        leaves = cut(_leaves(cells, depth, least, limit))
        met = counted_join(left.withColumn("cell", _lead(depth)), leaves, ["cell"])
        fits = _named(met.where(F.col("bits").isNotNull()))
        done = fits if done is None else done.unionByName(fits)
        if leaves.where(F.col("bits").isNull()).isEmpty():
            return done
        left = cut(met.where(F.col("bits").isNull()).select(*rows.columns))
        if depth == HASH_BITS:
            return done.unionByName(_paged(left, limit))
        depth, least = min(HASH_BITS, depth + MORE), depth + 1


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, hash, shard (its hash bits, and a page where a bucket is chained), bits, shard_bytes: one row per document."""
    return _placed(cut(_sized(narrow(docs, "doc_id", "text"))), limit).drop("uid")


def _bits(bits: Column) -> Column:
    return F.substring(F.lpad(F.bin("hash"), HASH_BITS, "0"), F.lit(1), bits)


def _named(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_bytes", "hash", "uid", _bits(F.col("bits")).alias("shard"), F.col("bits").cast("int").alias("bits"), F.col("bucket_bytes").alias("shard_bytes"))


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of one whole hash in pages: a row whose running total crosses a multiple of the limit starts a page.

    Half the limit a page keeps every page of rows within half the limit under it; larger rows have pages of their own.
    """
    half = max(1, limit // 2)
    large = F.col("n_bytes") > half
    known = rows.withColumns({"no_id": F.col("doc_id").isNull(), "small": F.when(large, F.lit(0)).otherwise(F.col("n_bytes")), "one": F.lit(1)})
    ordered = cut(running(known, ["hash", "no_id", "doc_id", "n_bytes", "uid"], {"before": "small", "place": "one"}))
    first = cut(ordered.groupBy("hash").agg(F.count("*").alias("n"), F.min("before").alias("first_before"), F.min("place").alias("first_place")))
    met = counted_join(ordered, first, ["hash"])
    alone = F.concat(F.lit("L"), (F.col("place") - F.col("first_place") + 1).cast("string"))
    shared = F.concat(F.lit("P"), F.floor((F.col("before") + F.col("small") - F.col("first_before")) / half).cast("string"))
    paged = cut(met.select(*rows.columns, F.concat(_bits(F.lit(HASH_BITS)), F.lit("/"), F.when(large, alone).otherwise(shared)).alias("shard")))
    sums = cut(paged.groupBy("shard").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("shard_bytes")))
    return counted_join(paged, sums, ["shard"]).select(*rows.columns, "shard", F.lit(HASH_BITS).alias("bits"), "shard_bytes")


def write(docs: DataFrame, path: str, limit: int = LIMIT) -> str:
    """Write the documents as one folder of Parquet per shard, and return the name of the folders' column.

    That is `shard`, or with underscores before it where docs has such a column.  Its values begin with `b`, so that no reader takes bits
    for a number.  The rows are stored once with a number each, and shards are joined by it, so repeated rows keep their pages.
    """
    spark, (name,) = docs.sparkSession, fresh(docs, "shard")
    folder = scratch(spark, "sharding")
    _sized(nested(docs, "doc_id", "text")).write.parquet(folder)
    whole = spark.read.parquet(folder)
    shards = _placed(cut(whole.drop("document")), limit).select("uid", F.concat(F.lit("b"), F.translate("shard", "/", "-")).alias("own"))
    found = whole.select("document", "uid").join(shards, "uid").select("document.*", F.col("own").alias(name))
    found.repartition(name).write.mode("overwrite").partitionBy(name).parquet(path)
    removed(spark, folder)
    return name
