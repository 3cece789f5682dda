"""Relations of the test tables that stand in for media tables.

The tables hold no media, so a user of ``events`` is a video: views and signups are its shot boundaries, other events its words
(value is the confidence), errors its audio activity, purchases its annotated ranges.  Values also serve as frame scores and brightness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t")
    return table(spark, sf_dir, "events").select("event_id", "user_id", F.col("user_id").cast("string").alias("video_id"), "event_type", "value", "props", t)


def videos(ev: DataFrame) -> DataFrame:
    name = F.concat(F.lit("clip_lov"), F.col("video_id"), F.lit("rp1.mp4"))
    fps = F.when(F.col("video_id").cast("bigint") % 2 == 0, F.lit(25.0)).otherwise(F.lit(29.97))
    return ev.groupBy("video_id").agg((F.max("t") + 60).alias("duration")).select("video_id", name.alias("video_name"), "duration", fps.alias("fps"))


def shots(ev: DataFrame) -> DataFrame:
    at = (F.row_number().over(Window.partitionBy("video_id").orderBy("t", "event_id")) - 1).alias("shot_index")
    return ev.where(F.col("event_type").isin("view", "signup")).select("video_id", at, F.col("t").alias("shot_time"))


def words(ev: DataFrame) -> DataFrame:
    spoken = F.when(F.col("event_id") % 7 == 0, F.lit("uh")).otherwise(F.col("event_type"))
    own = ev.where(~F.col("event_type").isin("view", "signup"))
    return own.select("video_id", F.col("event_id").alias("item_pos"), spoken.alias("word"), F.least(F.col("value") / 100, F.lit(1.0)).alias("conf"), F.col("t").alias("start_time"), (F.col("t") + F.col("value") * 10).alias("end_time"))


def audio_segments(ev: DataFrame) -> DataFrame:
    return ev.where("event_type = 'error'").select("video_id", F.col("t").alias("start_time"), (F.col("t") + F.col("value") * 300).alias("end_time"))


def truth(ev: DataFrame) -> DataFrame:
    return ev.where("event_type = 'purchase'").select("video_id", F.col("t").alias("gt_start"), (F.col("t") + F.col("value") * 600).alias("gt_end"))


def frames(ev: DataFrame) -> DataFrame:
    """One frame per event, its value the score and the brightness; a frame in eleven cannot be read."""
    at = (F.row_number().over(Window.partitionBy("video_id").orderBy("t", "event_id")) - 1).alias("frame_index")
    return ev.select("video_id", at, F.col("value").alias("score"), F.col("value").alias("brightness"), (F.col("event_id") % 11 != 0).alias("readable"))


#: Time of the stand-ins is that of events, so range joins deal it out by days.
WIDTH = 86_400.0


def samples(segments: DataFrame) -> DataFrame:
    """Silence of 2,048 samples for every other segment."""
    return segments.where("segment_index % 2 = 0").select("video_id", "segment_index", F.array_repeat(F.lit(0.0).cast("float"), 2048).alias("y"))


def faces(segments: DataFrame) -> DataFrame:
    """Two sampled frames of 100 by 200 for two segments in three; one box in the first, two in the second."""
    i = F.col("segment_index")
    box = lambda w, h: F.struct(F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), w.cast("double").alias("x2"), h.cast("double").alias("y2"), F.lit(1.0).alias("conf"))
    first, second = F.array(box(i % 50, F.lit(10))), F.array(box(F.lit(20), i % 30), box(F.lit(5), F.lit(7)))
    shown = segments.where("segment_index % 3 <> 0").select("video_id", "segment_index", F.explode(F.array(F.struct(F.lit(0).alias("no"), first.alias("boxes")), F.struct(F.lit(1).alias("no"), second.alias("boxes")))).alias("f"))
    return shown.select("video_id", "segment_index", F.col("f.no").alias("sample_no"), F.lit(100).alias("height"), F.lit(200).alias("width"), F.col("f.boxes").alias("boxes"))


BASE = """
ev AS (SELECT event_id, user_id, CAST(user_id AS VARCHAR) AS video_id, event_type, value, props, epoch_us(ts) / 1e6::DOUBLE AS t FROM events),
videos AS (SELECT video_id, 'clip_lov' || video_id || 'rp1.mp4' AS video_name, max(t) + 60 AS duration, CASE WHEN CAST(video_id AS BIGINT) % 2 = 0 THEN 25.0::DOUBLE ELSE 29.97::DOUBLE END AS fps FROM ev GROUP BY video_id),
shots AS (SELECT video_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY t, event_id) - 1 AS INTEGER) AS shot_index, t AS shot_time FROM ev WHERE event_type IN ('view', 'signup')),
segs AS (SELECT s.video_id, shot_index AS segment_index, shot_time AS segment_start, coalesce(lead(shot_time) OVER (PARTITION BY s.video_id ORDER BY shot_index), duration) AS segment_end FROM shots s JOIN videos USING (video_id)),
words AS (SELECT video_id, event_id AS item_pos, CASE WHEN event_id % 7 = 0 THEN 'uh' ELSE event_type END AS word, least(value / 100, 1.0::DOUBLE) AS conf, t AS start_time, t + value * 10 AS end_time FROM ev WHERE event_type NOT IN ('view', 'signup')),
audio_segments AS (SELECT video_id, t AS start_time, t + value * 300 AS end_time FROM ev WHERE event_type = 'error'),
truth AS (SELECT video_id, t AS gt_start, t + value * 600 AS gt_end FROM ev WHERE event_type = 'purchase'),
frames AS (SELECT video_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY t, event_id) - 1 AS INTEGER) AS frame_index, value AS score, value AS brightness, event_id % 11 <> 0 AS readable FROM ev)
"""
