"""Readers of the JSON documents that describe videos: shots, transcripts, ground truth, URI maps, model metadata."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .. import schemas as S
from ..functions.ids import media_id
from ..functions.timecode import timecode_to_seconds


def read_whole(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """path, document: one row per file."""
    files = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", glob).load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))


def entries(document: Column) -> Column:
    """key, value (as JSON text) of an object's entries in order; a repeated key has its last value, at the place of the first.

    The document is parsed once and its entries are sorted, so the time grows with their number and not with its square.
    """
    placed = F.transform(F.map_entries(F.from_json(document, "map<string,string>")), lambda e, i: F.struct(e["key"].alias("key"), i.alias("place"), e["value"].alias("value")))
    return _once(F.sort_array(placed), _last_values)


def _last_values(by_key: Column) -> Column:
    other = lambda e, i: ~e["key"].eqNullSafe(F.get(by_key, i)["key"])
    firsts, lasts = F.filter(by_key, lambda e, i: other(e, i - 1)), F.filter(by_key, lambda e, i: other(e, i + 1))
    merged = F.zip_with(firsts, lasts, lambda a, b: F.struct(a["place"].alias("place"), a["key"].alias("key"), b["value"].alias("value")))
    return F.transform(F.sort_array(merged), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, not again for each element that a function inside f sees."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def parse_shots(documents: DataFrame, fps: float = C.FRAMES_PER_SECOND, strict: bool = True) -> DataFrame:
    """Add shot_times, the times of a document's first object that has timecodes or seconds.

    Entries are taken in document order; seconds, even an empty list of them, come before timecodes.  A document without such an entry
    fails the query, or gives null if not strict.
    """
    objects = F.filter(entries(F.col("document")), lambda e: F.ltrim(e["value"]).startswith("{"))
    parsed = F.transform(objects, lambda e: F.from_json(e["value"], S.SHOT_ENTRY))
    usable = F.filter(parsed, lambda e: e["timecode"].isNotNull() | e["timecodes_seconds"].isNotNull())
    first = F.get(usable, F.lit(0))
    times = F.coalesce(first["timecodes_seconds"], F.transform(first["timecode"], lambda t: timecode_to_seconds(t, fps)))
    if strict:
        times = F.when(F.size(usable) > 0, times).otherwise(F.raise_error(F.lit("a shot document has no object with timecodes")).cast("array<double>"))
    return documents.withColumn("shot_times", times)


def parse_transcripts(documents: DataFrame) -> DataFrame:
    """Replace document by results: items and audio_segments."""
    return documents.withColumn("results", F.from_json("document", S.TRANSCRIPT_JSON, {"mode": "FAILFAST"})["results"]).drop("document")


def words(videos: DataFrame, transcripts: DataFrame) -> DataFrame:
    """The spoken words of each video; a video without a transcript has none.  Numbers that are none fail the query."""
    spoken = F.filter(F.col("results.items"), lambda i: i["type"] == "pronunciation")
    known = videos.select("video_id").join(transcripts, "video_id", "left")
    each = known.select("video_id", F.posexplode(spoken).alias("item_pos", "i"))
    first = F.get("i.alternatives", F.lit(0))
    return each.select("video_id", "item_pos", F.lower(first["content"]).alias("word"), first["confidence"].cast("double").alias("conf"), F.col("i.start_time").cast("double").alias("start_time"), F.col("i.end_time").cast("double").alias("end_time"))


def audio_segments(videos: DataFrame, transcripts: DataFrame) -> DataFrame:
    each = videos.select("video_id").join(transcripts, "video_id", "left").select("video_id", F.explode("results.audio_segments").alias("a"))
    return each.select("video_id", F.col("a.start_time").cast("double").alias("start_time"), F.col("a.end_time").cast("double").alias("end_time"))


def uri_map(documents: DataFrame) -> DataFrame:
    """media_id, uri of a map from URIs to objects with s3_uri; the id comes from s3_uri, else the URI, and the last entry wins."""
    each = documents.select(F.posexplode(entries(F.col("document"))).alias("pos", "e"))
    objects = each.where(F.ltrim(F.col("e.value")).startswith("{")).select("pos", F.col("e.key").alias("uri"), F.get_json_object("e.value", "$.s3_uri").alias("s3_uri"))
    named = objects.withColumn("media_id", F.coalesce(media_id(F.col("s3_uri")), media_id(F.col("uri")))).where("media_id is not null")
    return last_wins(named, "media_id", "uri", "pos")


def last_wins(entries: DataFrame, key: str, value: str, place: str) -> DataFrame:
    return entries.groupBy(key).agg(F.max_by(value, place).alias(value))


def ground_truth(documents: DataFrame) -> DataFrame:
    """uri, gt_start, gt_end of every entry whose two ends are numbers; other entries are skipped, and a repeated URI has its last list.

    The lists are dealt out by URI and parsed there, entry by entry.
    """
    lists = documents.select(F.explode(entries(F.col("document"))).alias("e")).select(F.col("e.key").alias("uri"), F.col("e.value").alias("ranges"))
    dealt = lists.where(F.ltrim("ranges").startswith("[")).repartition("uri")
    each = dealt.select("uri", F.explode(F.from_json("ranges", "array<string>")).alias("r")).where(F.ltrim("r").startswith("{"))
    read = each.select("uri", F.from_json("r", S.TRUTH_ENTRY).alias("r"))
    ends = read.select("uri", F.col("r.soundbite_start").try_cast("double").alias("gt_start"), F.col("r.soundbite_end").try_cast("double").alias("gt_end"))
    return ends.where("gt_start is not null and gt_end is not null")


def truth_of(videos: DataFrame, uris: DataFrame, truth: DataFrame) -> DataFrame:
    """video_id, gt_start, gt_end by the videos' media ids; unknown ids and URIs have no ranges."""
    named = videos.select("video_id", media_id(F.col("video_name")).alias("media_id"))
    return named.join(uris, "media_id").join(truth, "uri").select("video_id", "gt_start", "gt_end")


def model_metadata(spark: SparkSession, path: str) -> dict:
    """One small JSON object: feature_columns in order, and decision_threshold or its default."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return {"decision_threshold": C.DEFAULT_THRESHOLD, "feature_columns": list(C.FEATURE_COLUMNS), **json.loads(text)}


def load_model(spark: SparkSession, path: str):
    """A saved pipeline or random forest."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import RandomForestClassificationModel

    kind = json.loads(spark.read.text(f"{path}/metadata").first()[0])["class"]
    return (PipelineModel if kind.endswith("PipelineModel") else RandomForestClassificationModel).load(path)
