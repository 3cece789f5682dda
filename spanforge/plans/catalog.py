"""Registered queries over the test tables, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from .. import sinks
from ..functions import ids, timecode
from ..operators import audio, islands, labels, scoring, segments, shots, transcript, visual
from ..operators.range_join import points_in_segments
from ..schemas import SHOT_ENTRY
from ..sources import documents, files
from . import features as plan
from . import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, base: bool = True):
    """Register a function as a query of its name; ``base`` puts the stand-in relations before its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = f"WITH RECURSIVE {S.BASE}{sql}" if base else sql
        return f

    return register


def r6(*names: str) -> list[Column]:
    return [F.round(F.col(n), 6).alias(n) for n in names]


def _segments(ev: DataFrame) -> DataFrame:
    return segments.build_segments(S.shots(ev), S.videos(ev))


_IN_SEGMENT = "s.video_id = w.video_id AND w.start_time >= s.segment_start AND w.start_time < s.segment_end"


@query("SELECT video_id, segment_index, segment_start, segment_end FROM segs")
def segments_from_shots(spark, sf_dir):
    return _segments(S.events(spark, sf_dir))


@query(f"""SELECT s.video_id, s.segment_index, CAST(count(w.word) AS DOUBLE) AS word_count,
 round(CASE WHEN any_value(segment_end - segment_start) > 0 THEN count(w.word) / any_value(segment_end - segment_start) ELSE 0 END, 6) AS speech_rate,
 round(avg(conf), 9) AS confidence_mean, round(stddev_pop(conf), 6) AS confidence_std, min(conf) AS confidence_min
 FROM segs s LEFT JOIN words w ON {_IN_SEGMENT} GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY s.video_id, s.segment_index"))
def segment_word_stats(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    out = transcript.word_features(_segments(ev), S.words(ev), S.WIDTH)
    return out.select("video_id", "segment_index", "word_count", *r6("speech_rate", "confidence_std"), F.round("confidence_mean", 9).alias("confidence_mean"), "confidence_min")


@query(f"""SELECT s.video_id, s.segment_index, round(coalesce(count(*) FILTER (conf < 0.5) / nullif(count(word), 0), 0), 6) AS low_confidence_ratio,
 round(coalesce(count(*) FILTER (word IN ('uh', 'um', 'ah', 'er', 'hmm')) / nullif(count(word), 0), 0), 6) AS filler_word_ratio
 FROM segs s LEFT JOIN words w ON {_IN_SEGMENT} GROUP BY s.video_id, s.segment_index""")
def low_conf_filler_ratio(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    return transcript.word_features(_segments(ev), S.words(ev), S.WIDTH).select("video_id", "segment_index", *r6("low_confidence_ratio", "filler_word_ratio"))


@query(f"""SELECT s.video_id, s.segment_index, round(coalesce(sum(end_time - start_time), 0) / nullif(any_value(segment_end - segment_start), 0), 6) AS speech_coverage
 FROM segs s LEFT JOIN words w ON {_IN_SEGMENT} GROUP BY s.video_id, s.segment_index""")
def speech_coverage(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    return transcript.word_features(_segments(ev), S.words(ev), S.WIDTH).select("video_id", "segment_index", *r6("speech_coverage"))


@query(f""", placed AS (SELECT s.video_id, s.segment_index, segment_end - segment_start AS dur, word, start_time - lag(end_time) OVER (PARTITION BY s.video_id, s.segment_index ORDER BY start_time, item_pos) AS gap
 FROM segs s LEFT JOIN words w ON {_IN_SEGMENT})
 SELECT video_id, segment_index, round(CASE WHEN count(word) = 0 THEN any_value(dur) ELSE greatest(0, coalesce(max(gap), 0)) END, 6) AS max_silence_gap FROM placed GROUP BY video_id, segment_index""")
def max_silence_gap(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    return transcript.word_features(_segments(ev), S.words(ev), S.WIDTH).select("video_id", "segment_index", *r6("max_silence_gap"))


@query("""SELECT s.video_id, s.segment_index, CAST(count(a.video_id) AS DOUBLE) AS num_audio_segments_overlap
 FROM segs s LEFT JOIN audio_segments a ON s.video_id = a.video_id AND a.start_time < s.segment_end AND a.end_time > s.segment_start GROUP BY s.video_id, s.segment_index""")
def audio_segment_overlap(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    return transcript.overlap_counts(_segments(ev), S.audio_segments(ev), S.WIDTH).select("video_id", "segment_index", "num_audio_segments_overlap")


@query("""SELECT s.video_id, segment_index, round(segment_end - segment_start, 6) AS segment_duration, round(CASE WHEN duration > 0 THEN (segment_start + segment_end) / 2 / duration ELSE 0 END, 6) AS relative_position
 FROM segs s JOIN videos USING (video_id)""")
def temporal_features(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    return segments.with_temporal(_segments(ev), S.videos(ev)).select("video_id", "segment_index", *r6("segment_duration", "relative_position"))


_LABELS = """, hits AS (SELECT s.video_id, s.segment_index, greatest(0, least(segment_end, gt_end) - greatest(segment_start, gt_start)) AS common, segment_end - segment_start AS dur, greatest(gt_end - gt_start, 1e-9::DOUBLE) AS gt FROM segs s JOIN truth g USING (video_id)),
 labelled AS (SELECT s.video_id, s.segment_index, segment_start, segment_end, CAST(coalesce(max(CASE WHEN dur > 0 AND common > 0 AND (common / (dur + gt - common) > 0.3 OR common / dur > 0.5 OR (common / gt > 0.5 AND common / dur >= 0.2)) THEN 1 ELSE 0 END), 0) AS INTEGER) AS label
 FROM segs s LEFT JOIN hits h ON s.video_id = h.video_id AND s.segment_index = h.segment_index GROUP BY s.video_id, s.segment_index, segment_start, segment_end)
"""


@query(f"{_LABELS} SELECT video_id, segment_index, label FROM labelled")
def label_segments(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    return labels.label_segments(_segments(ev), S.truth(ev), S.WIDTH).select("video_id", "segment_index", "label")


@query(f"{_LABELS} SELECT video_id, count(*) AS n_segments, CAST(sum(label) AS BIGINT) AS n_positive FROM labelled GROUP BY video_id")
def label_counts_per_video(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    return labels.label_counts(labels.label_segments(_segments(ev), S.truth(ev), S.WIDTH))


@query(f"{_LABELS} SELECT video_id, segment_index FROM labelled WHERE label = 1")
def gt_exists_semi(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    return labels.positives(_segments(ev), S.truth(ev), S.WIDTH).select("video_id", "segment_index")


def _predictions(ev: DataFrame) -> DataFrame:
    """Every event as a segment that lasts to the next; its value over 100 the confidence, positive from 0.5 on."""
    order = Window.partitionBy("video_id").orderBy("t", "event_id")
    return ev.select(
        "video_id", (F.row_number().over(order) - 1).alias("segment_index"), F.col("t").alias("segment_start"), F.coalesce(F.lead("t").over(order), F.col("t") + 60).alias("segment_end"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("confidence"), scoring.predicted(F.least(F.col("value") / 100, F.lit(1.0)), 0.5).alias("predicted"),
    )


_PREDICTIONS = """, preds AS (SELECT video_id, CAST(row_number() OVER w - 1 AS INTEGER) AS segment_index, t AS segment_start, coalesce(lead(t) OVER w, t + 60) AS segment_end, least(value / 100, 1.0::DOUBLE) AS confidence, CASE WHEN least(value / 100, 1.0::DOUBLE) >= 0.5 THEN 1 ELSE 0 END AS predicted
 FROM ev WINDOW w AS (PARTITION BY video_id ORDER BY t, event_id)),
 numbered AS (SELECT *, segment_index - row_number() OVER (PARTITION BY video_id ORDER BY segment_index) AS run FROM preds WHERE predicted = 1),
 ranges AS (SELECT video_id, min(segment_index) AS place, round(arg_min(segment_start, segment_index), 3) AS soundbite_start, round(arg_max(segment_end, segment_index), 3) AS soundbite_end, avg(round(confidence, 4)) AS confidence FROM numbered GROUP BY video_id, run)
"""


@query(f"{_PREDICTIONS} SELECT video_id, soundbite_start, soundbite_end, round(confidence, 6) AS confidence FROM ranges")
def merge_adjacent(spark, sf_dir):
    ranges = plan.soundbites(_predictions(S.events(spark, sf_dir)))
    return ranges.select("video_id", "soundbite_start", "soundbite_end", *r6("confidence"))


_LINE_ORDER = "l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS i FROM lineitem),
 p AS (SELECT *, i - row_number() OVER (PARTITION BY l_orderkey ORDER BY i) AS run FROM n WHERE l_quantity >= 25)
 SELECT l_orderkey, round(arg_min(CAST(i AS DOUBLE), i), 3) AS soundbite_start, round(arg_max(CAST(i AS DOUBLE) + 1, i), 3) AS soundbite_end, round(avg(round(l_discount, 4)), 6) AS confidence FROM p GROUP BY l_orderkey, run""", base=False)
def merge_adjacent_large(spark, sf_dir):
    order = _LINE_ORDER.split(", ")
    rows = S.table(spark, sf_dir, "lineitem").withColumn("i", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)))
    rows = rows.withColumns({"s": F.col("i").cast("double"), "e": F.col("i").cast("double") + 1, "positive": (F.col("l_quantity") >= 25).cast("int")})
    out = islands.merge_adjacent(rows, ["l_orderkey"], ["i"], "s", "e", "positive", "l_discount")
    return out.select("l_orderkey", "soundbite_start", "soundbite_end", *r6("confidence"))


@query(f"SELECT event_id, CASE WHEN value / 100 >= {C.DECISION_THRESHOLD!r}::DOUBLE THEN 1 ELSE 0 END AS predicted FROM ev")
def threshold_predictions(spark, sf_dir):
    return S.events(spark, sf_dir).select("event_id", scoring.predicted(F.col("value") / 100, C.DECISION_THRESHOLD).alias("predicted"))


@query("""SELECT event_id, round(coalesce((CASE WHEN event_id % 5 <> 0 THEN value END - m) / CASE WHEN s > 0 THEN s ELSE 1 END, 0), 6) AS value
 FROM ev, (SELECT avg(value) AS m, stddev_pop(value) AS s FROM ev WHERE event_id % 5 <> 0)""")
def scale_then_impute(spark, sf_dir):
    rows = S.events(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))
    return scoring.impute(scoring.scale(rows, scoring.fit_scaler(rows, ["value"]), ["value"]), ["value"]).select("event_id", *r6("value"))


_RATIO = """, summed AS (SELECT *, (sum(score) OVER w - score) / 8 AS around, count(*) OVER w AS n FROM frames WINDOW w AS (PARTITION BY video_id ORDER BY frame_index ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)),
 rated AS (SELECT video_id, frame_index, score, CASE WHEN n = 9 THEN CASE WHEN abs(around) < 1e-5 THEN CASE WHEN score >= 20 THEN 255.0::DOUBLE ELSE 0 END ELSE least(score / around, 255.0::DOUBLE) END END AS ratio FROM summed)
"""


@query(f"{_RATIO} SELECT video_id, frame_index, round(ratio, 6) AS ratio FROM rated")
def adaptive_cut_ratio(spark, sf_dir):
    return shots.cut_ratio(S.frames(S.events(spark, sf_dir))).select("video_id", "frame_index", *r6("ratio"))


@query(f"""{_RATIO}, cuts AS (SELECT video_id, frame_index, row_number() OVER (PARTITION BY video_id ORDER BY frame_index) AS k FROM rated WHERE ratio >= 2.5 AND score >= 20 AND frame_index >= 6),
 fold AS (SELECT video_id, k, frame_index, frame_index AS kept FROM cuts WHERE k = 1 UNION ALL
 SELECT c.video_id, c.k, c.frame_index, CASE WHEN c.frame_index - f.kept >= 6 THEN c.frame_index ELSE f.kept END FROM fold f JOIN cuts c ON c.video_id = f.video_id AND c.k = f.k + 1),
 kept AS (SELECT DISTINCT video_id, kept AS scene_start FROM fold)
 SELECT * FROM kept UNION SELECT video_id, 0 FROM kept""")
def greedy_min_gap_cuts(spark, sf_dir):
    return shots.detect(S.frames(S.events(spark, sf_dir)), C.ShotSettings(min_scene_len=6))


def _flash_inputs(ev: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    frames = S.frames(ev)
    cuts = frames.where("frame_index % 5 = 0").select("video_id", F.col("frame_index").alias("scene_start"))
    last = frames.groupBy("video_id").agg(F.max("frame_index").alias("last"))
    pairs = cuts.join(last, "video_id").select("video_id", F.greatest(F.lit(0), F.col("scene_start") - 2).alias("before_index"), F.least(F.col("last"), F.col("scene_start") + 2).alias("after_index"))
    b, a = frames.select("video_id", F.col("frame_index").alias("before_index"), F.col("brightness").alias("b")), frames.select("video_id", F.col("frame_index").alias("after_index"), F.col("brightness").alias("a"))
    diffs = pairs.distinct().join(b, ["video_id", "before_index"]).join(a, ["video_id", "after_index"]).select("video_id", "before_index", "after_index", F.abs(F.col("b") - F.col("a")).alias("mean_abs_diff"))
    return cuts, frames.select("video_id", "frame_index", "brightness", "readable"), diffs


@query(""", cuts AS (SELECT video_id, frame_index AS c, max(frame_index) OVER (PARTITION BY video_id) AS last FROM frames QUALIFY frame_index % 5 = 0),
 seen AS (SELECT c.video_id, c.c, d.o, least(last, greatest(0, c.c + d.o)) AS look, f.brightness FROM cuts c, (SELECT unnest([-2, -1, 0, 1, 2]) AS o) d, frames f WHERE f.video_id = c.video_id AND f.frame_index = least(last, greatest(0, c.c + d.o)) AND f.readable),
 peaks AS (SELECT video_id, c, arg_max(look, (brightness, -o)) AS peak, max(brightness) AS pb FROM seen GROUP BY video_id, c),
 rf AS (SELECT * FROM frames WHERE readable)
 SELECT c.video_id, CAST(c.c AS INTEGER) AS scene_start FROM cuts c LEFT JOIN peaks p USING (video_id, c)
 LEFT JOIN rf b ON b.video_id = c.video_id AND b.frame_index = greatest(0, c.c - 2)
 LEFT JOIN rf a ON a.video_id = c.video_id AND a.frame_index = least(c.last, c.c + 2)
 LEFT JOIN rf r ON r.video_id = c.video_id AND r.frame_index = greatest(0, p.peak - 2)
 WHERE NOT (c.c <> 0 AND coalesce(pb - r.brightness > 20 AND abs(b.brightness - a.brightness) <= 20, false))""")
def flash_cut_filter(spark, sf_dir):
    return shots.filter_flash_cuts(*_flash_inputs(S.events(spark, sf_dir)))


@query(""", ranked AS (SELECT video_id, value, row_number() OVER (PARTITION BY video_id ORDER BY value) AS k, count(*) OVER (PARTITION BY video_id) AS n FROM ev),
 floors AS (SELECT video_id, avg(value) AS m, avg(value) FILTER (k <= greatest(1, n // 10)) AS noise, max(n) AS n FROM ranked GROUP BY video_id)
 SELECT video_id, round(noise, 6) AS noise_floor, round(CASE WHEN n >= 5 THEN CASE WHEN noise > 0 THEN 20 * log10(m / noise) ELSE 60 END END, 6) AS snr_estimate FROM floors""")
def noise_floor_snr(spark, sf_dir):
    rms = S.events(spark, sf_dir).groupBy("video_id").agg(F.array_sort(F.collect_list("value")).alias("rms"))
    return rms.select("video_id", F.round(audio.noise_floor(F.col("rms")), 6).alias("noise_floor"), F.round(audio.snr(F.col("rms")), 6).alias("snr_estimate"))


@query("""WITH e AS (SELECT vec_id, list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) AS q FROM embeddings),
 f AS (SELECT vec_id, sqrt(q * n / 64 / 2048) AS r FROM e, (SELECT unnest([1024, 1536, 2048, 2048, 1536, 1024]) AS n))
 SELECT vec_id, 6 AS n_frames, round(avg(r), 6) AS rms_mean, round(stddev_pop(r), 6) AS rms_std, round(min(r), 6) AS noise_floor, round(CASE WHEN min(r) > 0 THEN 20 * log10(avg(r) / min(r)) ELSE 60 END, 6) AS snr_estimate FROM f GROUP BY vec_id""", base=False)
def frame_rms(spark, sf_dir):
    """Signals of 40 repeats of each vector of 64 values, 2,560 samples: six frames, whose energy is that of the repeats in them."""
    y = F.flatten(F.array_repeat("embedding", 40))
    rms = audio.frames_of(S.table(spark, sf_dir, "embeddings").select("vec_id", y.alias("y"))).select("vec_id", "rms")
    places = {"rms_mean": audio.mean(F.col("rms")), "rms_std": audio.std(F.col("rms")), "noise_floor": audio.noise_floor(F.col("rms")), "snr_estimate": audio.snr(F.col("rms"))}
    return rms.select("vec_id", F.size("rms").alias("n_frames"), *[F.round(c, 6).alias(k) for k, c in places.items()])


@query()
def spectral_centroid(spark, sf_dir):
    """Signals of 16 repeats of each vector; the spectrum has no SQL form, so tests hold it against closed forms."""
    y = F.flatten(F.array_repeat("embedding", 16))
    frames = audio.frames_of(S.table(spark, sf_dir, "embeddings").select("vec_id", y.alias("y")))
    return frames.select("vec_id", F.size("rms").alias("n_frames"), F.round(audio.mean(F.col("rms")), 6).alias("rms_mean"), F.round(audio.mean(F.col("centroid")), 4).alias("spectral_centroid_mean"))


@query("""WITH b AS (SELECT vec_id, unnest([1, 5, 9]) AS k, embedding AS e FROM embeddings),
 s AS (SELECT vec_id, greatest(0, e[k]::DOUBLE) * 640 AS x1, greatest(0, e[k + 1]::DOUBLE) * 480 AS y1, least(1, e[k + 2]::DOUBLE + 0.5) * 640 AS x2, least(1, e[k + 3]::DOUBLE + 0.5) * 480 AS y2, abs(e[k]::DOUBLE) * 10 AS conf FROM b)
 SELECT v.vec_id, round(coalesce(max((x2 - x1) * (y2 - y1)) / (640 * 480), 0), 6) AS face_area_ratio FROM embeddings v LEFT JOIN s ON s.vec_id = v.vec_id AND conf >= 0.5 GROUP BY v.vec_id""", base=False)
def face_area_max(spark, sf_dir):
    e = lambda k: F.element_at("embedding", k).cast("double")
    box = lambda k: F.struct(e(k).alias("x1"), e(k + 1).alias("y1"), (e(k + 2) + 0.5).alias("x2"), (e(k + 3) + 0.5).alias("y2"), (F.abs(e(k)) * 10).alias("conf"))
    boxes = visual.scaled(visual.confident(F.array(box(1), box(5), box(9))), F.lit(640), F.lit(480))
    return S.table(spark, sf_dir, "embeddings").select("vec_id", F.round(visual.face_ratio(boxes, F.lit(640), F.lit(480)), 6).alias("face_area_ratio"))


@query("""SELECT video_id, segment_index, CAST(k AS INTEGER) AS sample_no, round(segment_start + (k + 1) / 3 * greatest(0, segment_end - segment_start), 3) AS sample_time FROM segs, (SELECT unnest([0, 1]) AS k)""")
def sample_timestamps(spark, sf_dir):
    return segments.sample_times(_segments(S.events(spark, sf_dir))).select("video_id", "segment_index", "sample_no", F.round("sample_time", 3).alias("sample_time"))


@query(""", f AS (SELECT event_id, event_id * 37 AS frame, CASE WHEN event_id % 2 = 0 THEN 25 ELSE 30 END AS fps FROM ev)
 SELECT event_id, printf('%02d:%02d:%02d:%02d', frame // fps // 3600, frame // fps // 60 % 60, frame // fps % 60, frame % fps) AS smpte, round(frame // fps + (frame % fps) / fps::DOUBLE, 6) AS seconds, round(frame // fps + (frame % fps) / 25.0::DOUBLE, 6) AS seconds_at_25 FROM f""")
def smpte_roundtrip(spark, sf_dir):
    rate = F.when(F.col("event_id") % 2 == 0, F.lit(25.0)).otherwise(F.lit(29.97))
    coded = S.events(spark, sf_dir).select("event_id", rate.alias("fps"), timecode.frame_to_smpte(F.col("event_id") * 37, rate).alias("smpte"))
    return coded.select("event_id", "smpte", timecode.smpte_to_seconds(F.col("smpte"), timecode.scene_fps(F.col("fps"))).alias("seconds"), F.round(timecode.timecode_to_seconds(F.col("smpte")), 6).alias("seconds_at_25"))


_NAMES = "CASE doc_id % 4 WHEN 0 THEN 'x_rw' || doc_id || 'rp3.mp4' WHEN 1 THEN 'LOV' || doc_id || 'RP1_cut.MP4' WHEN 2 THEN 'lov12' || doc_id ELSE source || '.mp4' END"


@query(f"""WITH n AS (SELECT doc_id, {_NAMES} AS name FROM documents)
 SELECT doc_id, regexp_replace(nullif(upper(regexp_extract(name, '(?i)(?:LOV|RW)\\d+RP\\d+', 0)), ''), '^RW', 'LOV') AS media_id FROM n""", base=False)
def media_id_extract(spark, sf_dir):
    return S.table(spark, sf_dir, "documents").select("doc_id", ids.media_id(F.expr(_NAMES)).alias("media_id"))


@query("""WITH u AS (SELECT page_id, replace(url, 'http://', 's3://') || '.v1.mp4' AS uri FROM pages)
 SELECT page_id, regexp_extract(uri, '^s3://([^/]+)/(.+)$', 1) AS bucket, regexp_extract(uri, '^s3://([^/]+)/(.+)$', 2) AS key, regexp_replace(regexp_extract(uri, '([^/]+)$', 1), '\\.[^.]*$', '') AS stem FROM u""", base=False)
def uri_parts(spark, sf_dir):
    uri = F.concat(F.replace("url", F.lit("http://"), F.lit("s3://")), F.lit(".v1.mp4"))
    return S.table(spark, sf_dir, "pages").select("page_id", ids.s3_bucket(uri).alias("bucket"), ids.s3_key(uri).alias("key"), ids.stem(uri).alias("stem"))


@query("""SELECT video_id, shot_index, round(shot_time, 6) AS shot_time FROM shots""")
def shots_json_parse(spark, sf_dir):
    """Shot lists written as documents and parsed again; every other document has an object without timecodes first."""
    ev = S.events(spark, sf_dir)
    lists = S.shots(ev).groupBy("video_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("shot_index", "shot_time"))), lambda s: s["shot_time"]).alias("times"))
    own = F.to_json(F.struct(F.struct(F.col("times").alias("timecodes_seconds")).alias("clip.mp4")))
    odd = F.when(F.col("video_id").cast("bigint") % 2 == 0, F.lit('{"min_scene_len":30,"notes":{"x":1},')).otherwise(F.lit('{"min_scene_len":30,'))
    parsed = documents.parse_shots(lists.select("video_id", F.concat(odd, F.substring(own, F.lit(2), F.length(own))).alias("document")))
    return segments.explode_shots(parsed).select("video_id", "shot_index", *r6("shot_time"))


@query("SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM ev GROUP BY 1")
def props_json_counts(spark, sf_dir):
    entry = F.get(documents.entries(F.col("props")), F.lit(0))
    return S.events(spark, sf_dir).groupBy(entry["value"].cast("int").alias("k")).agg(F.count("*").alias("n"))


@query("SELECT video_id, arg_max(event_type, event_id) AS uri FROM ev GROUP BY video_id")
def last_wins_map(spark, sf_dir):
    return documents.last_wins(S.events(spark, sf_dir).select("video_id", F.col("event_type").alias("uri"), "event_id"), "video_id", "uri", "event_id")


@query("SELECT doc_id, source AS video_name FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)", base=False)
def incremental_skip(spark, sf_dir):
    docs, done = S.table(spark, sf_dir, "documents"), S.table(spark, sf_dir, "labels")
    return files.without_artifact(docs, done, "doc_id").select("doc_id", F.col("source").alias("video_name"))


@query("""WITH l AS (SELECT doc_id, CASE WHEN quality = 1 THEN n_chars ELSE n_chars + 1 END AS remote FROM labels JOIN documents USING (doc_id) WHERE toxic = 0)
 SELECT 's3://bucket/' || doc_id || '.mp4' AS uri, doc_id || '.mp4' AS name FROM documents d LEFT JOIN l USING (doc_id) WHERE doc_id % 3 = 0 OR (remote IS NOT NULL AND remote <> n_chars)""", base=False)
def existing_artifacts_size(spark, sf_dir):
    docs, marks = S.table(spark, sf_dir, "documents").select("doc_id", "n_chars"), S.table(spark, sf_dir, "labels")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".mp4")).alias("name")
    wanted = docs.select(F.concat(F.lit("s3://bucket/"), F.col("doc_id").cast("string"), F.lit(".mp4")).alias("uri"))
    local = docs.where("doc_id % 3 <> 0").select(name, F.col("n_chars").alias("size"))
    remote = marks.where("toxic = 0").join(docs, "doc_id").select(name, F.when(F.col("quality") == 1, F.col("n_chars")).otherwise(F.col("n_chars") + 1).alias("size"))
    return files.to_fetch(wanted, local, remote).select("uri", "name")


@query("""WITH t AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) - 1 AS i FROM conversations WHERE role = 'user'),
 w AS (SELECT conv_id, lower(word) AS word, CASE WHEN i % 5 = 0 THEN 0.25::DOUBLE ELSE 0.75::DOUBLE END AS conf, turn * 1000.0::DOUBLE + i AS start_time FROM t WHERE i % 7 <> 6)
 SELECT conv_id, count(*) AS n_tokens, count(*) FILTER (word IN ('uh', 'um', 'ah', 'er', 'hmm')) AS n_fillers, count(*) FILTER (conf < 0.5) AS n_low, min(start_time) AS first_start FROM w GROUP BY conv_id""", base=False)
def transcript_tokens(spark, sf_dir):
    """Users' turns as transcripts, every seventh item a mark: written as JSON, parsed, and the spoken words counted."""
    i = F.col("i")
    spoken = S.table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("i", "word"))
    start = F.col("turn") * 1000.0 + i
    item = F.struct(
        F.when(i % 7 == 6, "punctuation").otherwise("pronunciation").alias("type"), start.cast("string").alias("start_time"), (start + 0.5).cast("string").alias("end_time"),
        F.array(F.struct(F.when(i % 5 == 0, "0.25").otherwise("0.75").alias("confidence"), F.col("word").alias("content"))).alias("alternatives"),
    )
    items = spoken.groupBy(F.col("conv_id").cast("string").alias("video_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "i", item.alias("item")))), lambda x: x["item"]).alias("items"))
    parsed = documents.parse_transcripts(items.select("video_id", F.to_json(F.struct(F.struct("items").alias("results"))).alias("document")))
    each = documents.words(parsed.select("video_id"), parsed)
    return each.groupBy(F.col("video_id").cast("bigint").alias("conv_id")).agg(F.count("*").alias("n_tokens"), F.count_if(F.col("word").isin(*C.FILLERS)).alias("n_fillers"), F.count_if(F.col("conf") < C.LOW_CONFIDENCE).alias("n_low"), F.min("start_time").alias("first_start"))


def _inputs(ev: DataFrame) -> plan.Inputs:
    return plan.Inputs(S.videos(ev), S.shots(ev), S.words(ev), S.audio_segments(ev), truth=S.truth(ev))


_ASSEMBLED = f"""{_LABELS}, placed AS (SELECT s.video_id, s.segment_index, word, conf, start_time, end_time, start_time - lag(end_time) OVER (PARTITION BY s.video_id, s.segment_index ORDER BY start_time, item_pos) AS gap FROM segs s LEFT JOIN words w ON {_IN_SEGMENT}),
 wf AS (SELECT video_id, segment_index, count(word) AS n, avg(conf) AS confidence_mean, stddev_pop(conf) AS confidence_std, min(conf) AS confidence_min, count(*) FILTER (conf < 0.5) AS low, count(*) FILTER (word IN ('uh', 'um', 'ah', 'er', 'hmm')) AS fillers, sum(end_time - start_time) AS spoken, greatest(0, coalesce(max(gap), 0)) AS gap FROM placed GROUP BY video_id, segment_index),
 oc AS (SELECT s.video_id, s.segment_index, count(a.video_id) AS n FROM segs s LEFT JOIN audio_segments a ON s.video_id = a.video_id AND a.start_time < s.segment_end AND a.end_time > s.segment_start GROUP BY s.video_id, s.segment_index),
 sized AS (SELECT *, segment_end - segment_start AS d FROM labelled),
 assembled AS (SELECT v.video_name, l.segment_index, segment_start, segment_end, @AUDIO, CAST(wf.n AS DOUBLE) AS word_count, round(CASE WHEN d > 0 THEN wf.n / d ELSE 0 END, 9) AS speech_rate, round(confidence_mean, 9) AS confidence_mean, round(confidence_std, 6) AS confidence_std, confidence_min,
 round(coalesce(low / nullif(wf.n, 0), 0), 9) AS low_confidence_ratio, round(coalesce(fillers / nullif(wf.n, 0), 0), 9) AS filler_word_ratio, round(CASE WHEN d > 0 THEN coalesce(spoken, 0) / d ELSE 0 END, 6) AS speech_coverage, CAST(oc.n AS DOUBLE) AS num_audio_segments_overlap,
 round(CASE WHEN wf.n = 0 THEN d ELSE gap END, 6) AS max_silence_gap, round(d, 6) AS segment_duration, round(CASE WHEN duration > 0 THEN (segment_start + segment_end) / 2 / duration ELSE 0 END, 6) AS relative_position, @FACES AS face_area_ratio, l.label
 FROM sized l JOIN videos v USING (video_id) JOIN wf USING (video_id, segment_index) JOIN oc USING (video_id, segment_index))"""
_NO_MEDIA = _ASSEMBLED.replace("@AUDIO", ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in C.AUDIO_COLUMNS)).replace("@FACES", "0.0::DOUBLE")
_SILENT = {"rms_mean": 0, "rms_std": 0, "spectral_centroid_mean": 0, "spectral_centroid_std": 0, "snr_estimate": 60}
_MEDIA = _ASSEMBLED.replace("@AUDIO", ", ".join(f"CASE WHEN l.segment_index % 2 = 0 AND d >= 0.1 THEN {v}.0::DOUBLE END AS {c}" for c, v in _SILENT.items()))
_MEDIA = _MEDIA.replace("@FACES", "CASE WHEN l.segment_index % 3 = 0 THEN 0.0::DOUBLE ELSE round(greatest(l.segment_index % 50 * 10, 20 * (l.segment_index % 30), 35) / 20000.0::DOUBLE, 9) END")
_PLACES = {"speech_rate": 9, "confidence_mean": 9, "confidence_std": 6, "low_confidence_ratio": 9, "filler_word_ratio": 9, "speech_coverage": 6, "max_silence_gap": 6, "segment_duration": 6, "relative_position": 6, "face_area_ratio": 9}


def _assembled(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.round(c, _PLACES[c]).alias(c) if c in _PLACES else c for c in rows.columns])


@query(f"{_NO_MEDIA} SELECT * FROM assembled")
def assemble_features(spark, sf_dir):
    """All 23 columns, of videos without decoded media."""
    return _assembled(plan.features(_inputs(S.events(spark, sf_dir)), width=S.WIDTH))


@query(f"{_MEDIA} SELECT * FROM assembled")
def assemble_features_media(spark, sf_dir):
    """All 23 columns, with signals of every other segment and faces of two in three."""
    ev = S.events(spark, sf_dir)
    segs = _segments(ev)
    return _assembled(plan.features(replace(_inputs(ev), samples=S.samples(segs), faces=S.faces(segs)), width=S.WIDTH))


@query(f"{_NO_MEDIA} SELECT * FROM assembled WHERE video_name NOT IN (SELECT video_name FROM videos JOIN ev USING (video_id) GROUP BY video_name HAVING count(*) FILTER (event_type = 'purchase') < 12)")
def assemble_features_incremental(spark, sf_dir):
    """The skip-list holds the videos with fewer than twelve purchases."""
    ev = S.events(spark, sf_dir)
    done = ev.groupBy("video_id").agg(F.count_if(F.col("event_type") == "purchase").alias("n")).where("n < 12")
    return _assembled(plan.features_incremental(_inputs(ev), S.videos(ev).join(done, "video_id").select("video_name"), width=S.WIDTH))


@query(f"""{_NO_MEDIA}, scored AS (SELECT *, CASE WHEN word_count >= 2 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END AS confidence FROM assembled)
 SELECT video_name, segment_index, word_count, speech_coverage, confidence, CASE WHEN confidence >= 0.5 THEN 1 ELSE 0 END AS predicted FROM scored""")
def infer_segments(spark, sf_dir):
    """Inference with a model that decides by the number of words, which is scaled before: every segment once, its columns as they were."""
    ev = S.events(spark, sf_dir)
    params = spark.createDataFrame([("word_count", 1.0, 2.0)], "feature string, centre double, scale double")
    scored, _, _ = plan.infer(_inputs(ev), params, scoring.Threshold(0.5, 0.25, 0.75), 0.5, ["word_count"], S.WIDTH)
    return _assembled(scored).select("video_name", "segment_index", "word_count", "speech_coverage", "confidence", "predicted")


@query(f"""{_LABELS}, listing AS (SELECT video_id, 'a_' || video_id AS shot_file FROM videos UNION ALL SELECT video_id, 'b_' || video_id FROM videos WHERE fps < 28)
 SELECT shot_file, segment_index, round(segment_start, 6) AS segment_start, label FROM labelled JOIN listing USING (video_id)""")
def shot_files_twice(spark, sf_dir):
    """Videos of 25 frames a second have two shot files, and give their rows twice."""
    ev = S.events(spark, sf_dir)
    v = S.videos(ev)
    name = lambda k: F.concat(F.lit(k), F.col("video_id")).alias("shot_file")
    listing = v.select("video_id", name("a_")).unionByName(v.where("fps < 28").select("video_id", name("b_")))
    own = S.shots(ev).join(listing, "video_id").select(F.col("shot_file").alias("video_id"), "shot_index", "shot_time")
    rows = plan.feature_rows(plan.per_shot_file(replace(_inputs(ev), shots=own), listing), S.WIDTH)
    return rows.select(F.col("video_id").alias("shot_file"), "segment_index", *r6("segment_start"), "label")


@query("SELECT video_id, segment_index, segment_start, segment_end FROM segs UNION ALL SELECT video_id, segment_index, segment_start, segment_end FROM segs")
def union_video_tables(spark, sf_dir):
    """A bag: the table of all videos, twice."""
    segs = _segments(S.events(spark, sf_dir))
    return segs.unionByName(segs)


@query(f"{_PREDICTIONS} SELECT video_id, 'range' AS kind, soundbite_start AS start_time, soundbite_end AS end_time, CAST(NULL AS INTEGER) AS prediction, round(confidence, 6) AS confidence FROM ranges UNION ALL SELECT video_id, 'segment', round(segment_start, 6), round(segment_end, 6), predicted, round(confidence, 4) FROM preds")
def prediction_document(spark, sf_dir):
    """Documents are written as JSON and read back, so the rows are what a reader of them sees."""
    scored = _predictions(S.events(spark, sf_dir)).withColumn("video_name", F.col("video_id"))
    made = sinks.prediction_documents(scored, plan.soundbites(scored))
    schema = "video string, soundbites array<struct<soundbite_start: double, soundbite_end: double, confidence: double>>, segments array<struct<index: int, start: double, end: double, prediction: int, confidence: double>>"
    read = made.select("video_id", F.from_json("document", schema).alias("d"))
    ranges = read.select("video_id", F.explode("d.soundbites").alias("r")).select("video_id", F.lit("range").alias("kind"), F.col("r.soundbite_start").alias("start_time"), F.col("r.soundbite_end").alias("end_time"), F.lit(None).cast("int").alias("prediction"), F.round("r.confidence", 6).alias("confidence"))
    rows = read.select("video_id", F.explode("d.segments").alias("s")).select("video_id", F.lit("segment").alias("kind"), F.round("s.start", 6).alias("start_time"), F.round("s.end", 6).alias("end_time"), F.col("s.prediction").alias("prediction"), F.col("s.confidence").alias("confidence"))
    return ranges.unionByName(rows)


@query(f"{_PREDICTIONS} SELECT (SELECT count(*) FROM preds) AS n_segments, (SELECT count(*) FROM preds WHERE predicted = 1) AS n_positive, (SELECT count(*) FROM ranges) AS n_ranges")
def summary_totals(spark, sf_dir):
    scored = _predictions(S.events(spark, sf_dir))
    return sinks.summary(scored, plan.soundbites(scored))


@query(f"SELECT s.video_id, s.segment_index, w.item_pos FROM segs s JOIN words w ON {_IN_SEGMENT}")
def words_in_segments_bucketed(spark, sf_dir):
    """The range join with time buckets of a day."""
    ev = S.events(spark, sf_dir)
    return points_in_segments(_segments(ev), S.words(ev), "start_time", S.WIDTH).select("video_id", "segment_index", "item_pos")


@query("""SELECT s.video_id, shot_index, printf('%02d:%02d:%02d:%02d', f // r // 3600, f // r // 60 % 60, f // r % 60, f % r) AS timecode, round(f // r + (f % r) / r::DOUBLE, 6) AS shot_time
 FROM (SELECT video_id, shot_index, CAST(shot_index AS BIGINT) * 101 AS f FROM shots) s JOIN (SELECT video_id, CAST(round(fps) AS BIGINT) AS r FROM videos) v USING (video_id)""")
def shot_timecodes(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    cuts = S.shots(ev).select("video_id", (F.col("shot_index").cast("bigint") * 101).alias("scene_start"))
    return shots.shot_times(cuts, S.videos(ev)).select("video_id", "shot_index", "timecode", "shot_time")


@query("""SELECT 'LOV' || video_id || 'RP1' AS media_id, 'd/' || 'clip_lov' || video_id || 'rp1.mp4' AS path FROM videos""")
def files_by_media_id(spark, sf_dir):
    v = S.videos(S.events(spark, sf_dir))
    listing = v.select(F.col("video_name").alias("name"), F.concat(F.lit("d/"), F.col("video_name")).alias("path"))
    return files.find_by_id(v.select(ids.media_id(F.col("video_name")).alias("media_id")), listing, ".mp4")


def _uris(v: DataFrame) -> DataFrame:
    """One document: each video's URI, with an s3_uri of the other prefix for those of 25 frames a second."""
    entry = F.concat(F.to_json(F.struct(F.concat(F.lit("u/lov"), "video_id", F.lit("rp1")).alias("k"))), F.lit(""))
    key = F.get_json_object(entry, "$.k")
    value = F.when(F.col("fps") < 28, F.to_json(F.struct(F.concat(F.lit("s3://b/rw"), "video_id", F.lit("rp1.mp4")).alias("s3_uri")))).otherwise(F.lit("{}"))
    each = F.concat(F.lit('"'), key, F.lit('":'), value)
    return v.agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(each)), ","), F.lit("}")).alias("document"))


@query("""SELECT 'LOV' || video_id || 'RP1' AS media_id, 'u/lov' || video_id || 'rp1' AS uri FROM videos""")
def uri_map(spark, sf_dir):
    return documents.uri_map(_uris(S.videos(S.events(spark, sf_dir)))).select("media_id", "uri")


@query("""SELECT video_id, round(gt_start, 6) AS gt_start, round(gt_end, 6) AS gt_end FROM truth""")
def truth_by_uri(spark, sf_dir):
    """Ranges in a document by URI, each with an entry that lacks an end and one that is no number, found by the videos' ids."""
    ev = S.events(spark, sf_dir)
    v = S.videos(ev)
    entry = lambda a, b: F.struct(a.cast("string").alias("soundbite_start"), b.cast("string").alias("soundbite_end"))
    t = S.truth(ev)
    bad = [entry(F.lit(1.0), F.lit(None)), entry(F.lit("x"), F.lit("2"))]
    lists = t.groupBy("video_id").agg(F.concat(F.collect_list(entry(F.col("gt_start"), F.col("gt_end"))), F.array(*bad)).alias("r"))
    each = lists.select(F.concat(F.lit('"u/lov'), "video_id", F.lit('rp1":'), F.to_json("r")).alias("e"))
    document = each.agg(F.concat(F.lit("{"), F.array_join(F.collect_list("e"), ","), F.lit(',"nowhere":[]}')).alias("document"))
    found = documents.truth_of(v, documents.uri_map(_uris(v)), documents.ground_truth(document))
    return found.select("video_id", *r6("gt_start", "gt_end"))


@query("""SELECT w.video_id, item_pos, word, conf, round(start_time, 6) AS start_time, round(end_time, 6) AS end_time FROM
 (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY start_time, item_pos) - 1 AS pos FROM words) w""".replace("item_pos, word, conf, round", "CAST(pos AS INTEGER) AS item_pos, lower(word) AS word, conf, round"))
def transcript_words(spark, sf_dir):
    """Words written as transcripts, in capitals and with a mark after each, read back; videos without words have none."""
    ev = S.events(spark, sf_dir)
    text = lambda c: F.col(c).cast("string")
    word = F.struct(F.lit("pronunciation").alias("type"), text("start_time").alias("start_time"), text("end_time").alias("end_time"), F.array(F.struct(text("conf").alias("confidence"), F.upper("word").alias("content"))).alias("alternatives"))
    mark = F.struct(F.lit("punctuation").alias("type"), F.lit(None).cast("string").alias("start_time"), F.lit(None).cast("string").alias("end_time"), F.array(F.struct(F.lit("0.0").alias("confidence"), F.lit(",").alias("content"))).alias("alternatives"))
    ordered = F.array_sort(F.collect_list(F.struct("start_time", "item_pos", word.alias("word"), mark.alias("mark"))))
    items = F.flatten(F.transform(ordered, lambda x: F.array(x["word"], x["mark"])))
    made = S.words(ev).groupBy("video_id").agg(items.alias("items")).select("video_id", F.to_json(F.struct(F.struct("items").alias("results"))).alias("document"))
    spoken = documents.words(S.videos(ev), documents.parse_transcripts(made))
    return spoken.select("video_id", "item_pos", "word", "conf", *r6("start_time", "end_time"))


@query("""SELECT 'a_rw' || video_id || 'rp1_weighted_adaptive_prediction.json' AS shot_file, video_name FROM videos UNION ALL SELECT 'b_lov' || video_id || 'rp1_weighted_adaptive_prediction.json', video_name FROM videos WHERE fps < 28""")
def available_videos(spark, sf_dir):
    """Shot files by video, with a file of no video and one that is no shot file besides."""
    v = S.videos(S.events(spark, sf_dir))
    made = lambda k: F.concat(F.lit(k), "video_id", F.lit("rp1" + files.SHOTS)).alias("name")
    names = v.select(made("a_rw")).unionByName(v.where("fps < 28").select(made("b_lov")))
    names = names.unionByName(spark.createDataFrame([("c_lov0000000rp9" + files.SHOTS,), ("lov1rp1.json",)], "name string"))
    return files.available_videos(names, v.select(F.concat(F.lit("d/"), "video_name").alias("path"), F.col("video_name").alias("name")))


@query("""SELECT video_name, CASE WHEN fps < 28 THEN 't/RW' || video_id || 'RP1_transcript_raw.json' ELSE 't/' || regexp_replace(video_name, '\\.mp4$', '') || '_transcript_raw.json' END AS transcript_path FROM videos""".replace("\\\\", "\\"))
def resolve_paths(spark, sf_dir):
    """Transcripts found by id where there is a file, and else named after the video."""
    v = S.videos(S.events(spark, sf_dir))
    name = F.concat(F.lit("RW"), "video_id", F.lit("RP1" + files.TRANSCRIPT))
    listing = v.where("fps < 28").select(name.alias("name"), F.concat(F.lit("t/"), name).alias("path"))
    return files.resolve(v.select("video_name"), listing, "t", files.TRANSCRIPT, "transcript_path").select("video_name", "transcript_path")


@query("""SELECT video_id, shot_index, timecode, round(shot_time, 6) AS shot_time FROM
 (SELECT s.video_id, shot_index, printf('%02d:%02d:%02d:%02d', f // r // 3600, f // r // 60 % 60, f // r % 60, f % r) AS timecode, f // r + (f % r) / r::DOUBLE AS shot_time
 FROM (SELECT video_id, shot_index, CAST(shot_index AS BIGINT) * 101 AS f FROM shots) s JOIN (SELECT video_id, CAST(round(fps) AS BIGINT) AS r FROM videos) v USING (video_id))""")
def shot_documents(spark, sf_dir):
    """Shot documents written as JSON and read back, timecodes and seconds alike."""
    ev = S.events(spark, sf_dir)
    v = S.videos(ev)
    cuts = S.shots(ev).select("video_id", (F.col("shot_index").cast("bigint") * 101).alias("scene_start"))
    made = shots.shot_documents(shots.shot_times(cuts, v), v)
    entry = F.from_json(F.element_at(F.filter(documents.entries(F.col("document")), lambda e: e["key"] == F.col("video_name")), 1)["value"], SHOT_ENTRY)
    both = documents.parse_shots(made.join(v.select("video_id"), "video_id")).select("video_id", F.posexplode(F.arrays_zip(entry["timecode"].alias("timecode"), F.col("shot_times").alias("seconds"))).alias("shot_index", "s"))
    return both.select("video_id", "shot_index", F.col("s.timecode").alias("timecode"), F.round("s.seconds", 6).alias("shot_time"))


@query("""SELECT s.video_id, segment_index, sample_no, f.frame_index, f.score FROM
 (SELECT video_id, segment_index, CAST(k AS INTEGER) AS sample_no, CAST(round((segment_index * 3 + (k + 1) / 3::DOUBLE * 2) * 1.0::DOUBLE) AS INTEGER) AS frame_index FROM segs, (SELECT unnest([0, 1]) AS k)) s JOIN frames f USING (video_id, frame_index)""".replace("SELECT s.video_id, segment_index, sample_no, f.frame_index, f.score", "SELECT video_id, segment_index, sample_no, frame_index, score"))
def sampled_frames(spark, sf_dir):
    """Sampled times of segments of two seconds every three, at one frame a second, and the frames there."""
    ev = S.events(spark, sf_dir)
    start = (F.col("segment_index") * 3).cast("double")
    short = _segments(ev).select("video_id", "segment_index", start.alias("segment_start"), (start + 2).alias("segment_end"))
    return visual.frame_lookup(segments.sample_times(short), S.frames(ev).select("video_id", "frame_index", "score"), 1.0).select("video_id", "segment_index", "sample_no", "frame_index", "score")


@query("""SELECT video_id, segment_index, CASE WHEN segment_index % 3 = 0 THEN 0.0::DOUBLE ELSE round(greatest(segment_index % 50 * 10, 20 * (segment_index % 30), 35) / 20000.0::DOUBLE, 9) END AS face_area_ratio FROM segs""")
def face_area_of_frames(spark, sf_dir):
    """The larger share of two sampled frames, none where no frame could be read."""
    segs = _segments(S.events(spark, sf_dir))
    return visual.visual_features(segs, S.faces(segs)).select("video_id", "segment_index", F.round("face_area_ratio", 9).alias("face_area_ratio"))


@query("""SELECT video_id, segment_index, count(*) AS n_samples, CAST(sum(x) AS BIGINT) AS total, CAST(min(x) AS BIGINT) AS first, CAST(max(x) AS BIGINT) AS last FROM
 (SELECT video_id, segment_index, unnest(range(segment_index * 37 + 5, least(segment_index * 37 + 55, n))) AS x FROM segs JOIN (SELECT video_id, count(*) * 10 AS n FROM ev GROUP BY video_id) USING (video_id)) GROUP BY video_id, segment_index""")
def segment_signals(spark, sf_dir):
    """Signals that count upwards, ten samples an event, in blocks of 16; each segment is cut out of the blocks it meets."""
    ev = S.events(spark, sf_dir)
    signals = ev.groupBy("video_id").agg(F.transform(F.sequence(F.lit(0), F.count("*").cast("int") * 10 - 1), lambda x: x.cast("float")).alias("y"))
    start = (F.col("segment_index") * 37 + 5).cast("double")
    short = _segments(ev).select("video_id", "segment_index", start.alias("segment_start"), (start + 50).alias("segment_end"))
    cut = audio.segment_samples(short, audio.blocks_of(signals, 16), 1, 16)
    y = F.col("y")
    return cut.where(F.size(y) > 0).select("video_id", "segment_index", F.size(y).cast("bigint").alias("n_samples"), F.aggregate(y, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint")).alias("total"), F.array_min(y).cast("bigint").alias("first"), F.array_max(y).cast("bigint").alias("last"))
