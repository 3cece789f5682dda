"""Golden cases, properties and end-to-end runs of the segment engine."""

import io
import json
import math
import re
import time
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge import config as C
from spanforge import sinks
from spanforge.functions import ids, timecode
from spanforge.operators import audio, detectors, labels, scoring, segments, shots, transcript, visual
from spanforge.operators.range_join import overlapping, points_in_segments
from spanforge.plans import features as plan
from spanforge.sources import documents, files, media, remote
from spanforge.streaming import incremental


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_timecodes(spark):
    assert one(spark, timecode.timecode_to_seconds(F.lit(" 00:01:02:05 "))) == pytest.approx(62.2)
    assert one(spark, timecode.smpte_to_seconds(F.lit("00:01:57:05"), 25)) == 117.2
    assert one(spark, timecode.frame_to_smpte(F.lit(90_061 * 30 + 7), F.lit(29.97))) == "25:01:01:07"
    with pytest.raises(Exception):
        one(spark, timecode.smpte_to_seconds(F.lit("00:01:57"), 25))


@pytest.mark.parametrize(("name", "want"), [("x_rw12rp3.mp4", "LOV12RP3"), ("abc.mp4", None), ("LOV1RP2_RW3RP4", "LOV1RP2"), (None, None)])
def test_media_id(spark, name, want):
    assert one(spark, ids.media_id(F.lit(name).cast("string"))) == want


@pytest.mark.parametrize(("path", "want"), [("a/b.c/x.tar.gz", "x.tar"), ("/v/.hidden", ".hidden"), ("plain", "plain"), ("d/x.mp4", "x")])
def test_stem(spark, path, want):
    assert one(spark, ids.stem(F.lit(path))) == want


def test_s3(spark):
    assert tuple(one(spark, ids.checked_s3(F.lit("s3://b/k/x.mp4")))) == ("b", "k/x.mp4")
    for bad in ("s3://b", "http://b/k", "s3:///k", "s3://b/"):
        with pytest.raises(Exception):
            one(spark, ids.checked_s3(F.lit(bad)))


def videos(spark, *rows):
    return spark.createDataFrame(rows, "video_id string, video_name string, duration double, fps double")


def segs(spark, *rows):
    return spark.createDataFrame([("v", i, float(a), float(b)) for i, (a, b) in enumerate(rows)], "video_id string, segment_index int, segment_start double, segment_end double")


def test_segments(spark):
    s = spark.createDataFrame([("v", 0, 0.0), ("v", 1, 4.0), ("w", 0, 5.0), ("w", 1, 2.0)], "video_id string, shot_index int, shot_time double")
    v = videos(spark, ("v", "v.mp4", 10.0, 25.0), ("w", "w.mp4", 9.0, 25.0), ("none", "n.mp4", 3.0, 25.0))
    got = {(r.video_id, r.segment_index): (r.segment_start, r.segment_end) for r in segments.build_segments(s, v).collect()}
    assert got == {("v", 0): (0, 4), ("v", 1): (4, 10), ("w", 0): (5, 2), ("w", 1): (2, 9)}


@pytest.mark.parametrize(("seg", "gt", "want"), [((0, 20), (8, 14), 1), ((0, 100), (10, 20), 0), ((0, 10), (4, 6), 1), ((0, 10), (0, 5), 1), ((5, 5), (0, 9), 0), ((0, 10), (10, 20), 0)])
def test_labels(spark, seg, gt, want):
    truth = spark.createDataFrame([("v", float(gt[0]), float(gt[1]))], "video_id string, gt_start double, gt_end double")
    s = segs(spark, seg)
    assert labels.label_segments(s, truth).first().label == want
    assert labels.positives(s, truth).count() == want
    assert labels.label_segments(s, truth.limit(0)).first().label == 0 and labels.label_segments(s, None).first().label is None


WORDS = "video_id string, item_pos int, word string, conf double, start_time double, end_time double"


def test_transcript(spark):
    s = segs(spark, (0, 7), (7, 14), (14, 20))
    w = spark.createDataFrame([("v", 0, "um", 0.4, 1.0, 2.0), ("v", 1, "a", 0.5, 1.5, 5.0), ("v", 2, "b", 0.9, 3.0, 4.0), ("v", 3, "c", 0.8, 7.0, 8.0), ("v", 4, "early", 1.0, -1.0, 0.0)], WORDS)
    a = spark.createDataFrame([("v", 7.0, 14.0), ("v", 0.0, 7.0), ("v", 3.0, 15.0)], "video_id string, start_time double, end_time double")
    rows = {r.segment_index: r for r in transcript.transcript_features(s, w, a).collect()}
    first, second, none = rows[0], rows[1], rows[2]
    assert (first.word_count, first.max_silence_gap, first.num_audio_segments_overlap) == (3, 0, 2)
    assert first.low_confidence_ratio == pytest.approx(1 / 3) == first.filler_word_ratio
    assert first.confidence_std == pytest.approx(np.std([0.4, 0.5, 0.9])) and first.speech_coverage == pytest.approx(5.5 / 7)
    assert (second.word_count, second.confidence_std, second.max_silence_gap) == (1, 0, 0)
    assert (none.word_count, none.max_silence_gap, none.confidence_mean, none.speech_rate) == (0, 6, None, 0)


def test_bucketed_joins_equal_plain_ones(spark):
    rng = np.random.default_rng(42)
    t = np.sort(rng.uniform(0, 100, 40))
    s = segs(spark, *zip(t, [*t[1:], 100]), (50, 50), (60, 40))
    p = spark.createDataFrame([("v", float(x)) for x in rng.uniform(-5, 110, 200)], "video_id string, t double")
    r = spark.createDataFrame([("v", float(x), float(x + d)) for x, d in zip(rng.uniform(0, 90, 100), rng.uniform(-1, 20, 100))], "video_id string, a double, b double")
    key = lambda df: sorted(map(tuple, df.collect()))
    for width in (0.5, 7.0, 1000.0):
        assert key(points_in_segments(s, p, "t", width).select("segment_index", "t")) == key(points_in_segments(s, p, "t").select("segment_index", "t"))
        assert key(overlapping(s, r, "a", "b", width).select("segment_index", "a", "b")) == key(overlapping(s, r, "a", "b").select("segment_index", "a", "b"))


def test_islands(spark):
    conf = [0.1, 0.9, 0.7, 0.1, 0.5]
    rows = spark.createDataFrame([("v", i, float(i), i + 1.0, p, c) for i, (p, c) in enumerate(zip([0, 1, 1, 0, 1], conf))], "video_id string, segment_index int, segment_start double, segment_end double, predicted int, confidence double")
    got = sorted((r.soundbite_start, r.soundbite_end, round(r.confidence, 6)) for r in plan.soundbites(rows).collect())
    assert got == [(1, 3, 0.8), (4, 5, 0.5)]
    assert plan.soundbites(rows.withColumn("predicted", F.lit(0))).count() == 0


def test_shot_documents(spark):
    docs = [
        '{"a":{"foo":1},"b":{"timecodes_seconds":[]},"c":{"timecode":["00:00:01:00"]}}',
        '{"min":3,"v.mp4":{"timecode":["00:00:01:05","00:01:00:00"]}}',
        '{"v":{"timecode":["00:00:01:00"],"timecodes_seconds":[2.5]}}',
    ]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "video_id int, document string")
    got = {r.video_id: r.shot_times for r in documents.parse_shots(df).collect()}
    assert got == {0: [], 1: [1.2, 60.0], 2: [2.5]}
    bad = spark.createDataFrame([(0, '{"x":1}')], "video_id int, document string")
    assert documents.parse_shots(bad, strict=False).first().shot_times is None
    with pytest.raises(Exception):
        documents.parse_shots(bad).collect()


def test_shot_document_round_trip(spark):
    v = videos(spark, ("v", "v.mp4", 10.0, 25.0), ("n", "none.mp4", 3.0, 25.0))
    cuts = spark.createDataFrame([("v", 0), ("v", 90)], "video_id string, scene_start int")
    made = shots.shot_documents(shots.shot_times(cuts, v), v)
    got = {r.video_id: r.shot_times for r in documents.parse_shots(made).collect()}
    assert got == {"v": [0.0, 3.6], "n": []}
    assert json.loads(made.where("video_id = 'v'").first().document)["min_scene_len"] == 30
    assert [r.video_id for r in shots.new_videos(v, made.where("video_id = 'v'")).collect()] == ["n"]


def test_transcript_truth_and_uris(spark):
    t = json.dumps({"results": {"items": [{"type": "pronunciation", "start_time": "0.5", "end_time": 0.9, "alternatives": [{"confidence": "0.98", "content": "Um"}, {"confidence": "0", "content": "x"}]}, {"type": "punctuation", "alternatives": [{"confidence": "0.0", "content": ","}]}]}})
    v = videos(spark, ("a", "lov1rp1.mp4", 3.0, 25.0), ("b", "lov2rp1.mp4", 3.0, 25.0))
    parsed = documents.parse_transcripts(spark.createDataFrame([("a", t)], "video_id string, document string"))
    assert [tuple(r) for r in documents.words(v, parsed).collect()] == [("a", 0, "um", 0.98, 0.5, 0.9)]
    assert documents.audio_segments(v, parsed).count() == 0
    uris = documents.uri_map(spark.createDataFrame([('{"u1":{"s3_uri":"s3://b/rw1rp1.mp4"},"u2":{"s3_uri":"s3://b/LOV1RP1.mp4"},"x/lov2rp1":{},"bad":3}',)], "document string"))
    assert {r.media_id: r.uri for r in uris.collect()} == {"LOV1RP1": "u2", "LOV2RP1": "x/lov2rp1"}
    truth = documents.ground_truth(spark.createDataFrame([('{"u2":[{"soundbite_start":1,"soundbite_end":2.5},{"soundbite_start":"x","soundbite_end":3},{"soundbite_end":3}],"zz":[]}',)], "document string"))
    assert [tuple(r) for r in documents.truth_of(v, uris, truth).collect()] == [("a", 1.0, 2.5)]


@pytest.mark.parametrize(("jump", "diff", "keep"), [(20, 20, True), (21, 20, False), (21, 20.1, True)])
def test_flash(spark, jump, diff, keep):
    stats = spark.createDataFrame([("v", i, 10.0 + (jump if i == 6 else 0), True) for i in range(12)], "video_id string, frame_index int, brightness double, readable boolean")
    cuts = spark.createDataFrame([("v", 0), ("v", 6)], "video_id string, scene_start int")
    diffs = spark.createDataFrame([("v", 4, 8, float(diff)), ("v", 0, 2, 0.0)], "video_id string, before_index int, after_index int, mean_abs_diff double")
    got = {r.scene_start for r in shots.filter_flash_cuts(cuts, stats, diffs).collect()}
    assert got == ({0, 6} if keep else {0})
    assert shots.filter_flash_cuts(cuts, stats.where("frame_index <> 8"), diffs).count() == 2


def test_min_gap(spark):
    p = spark.createDataFrame([("v", x) for x in (3, 9, 10, 14, 30)], "video_id string, at int")
    assert sorted(r["at"] for r in shots.greedy_min_gap(p, "at", 6).collect()) == [3, 9, 30]


def test_audio_closed_forms(spark):
    t = np.arange(16_000) / 16_000
    rms, centroid = audio.frame_values(np.sin(2 * math.pi * 1000 * t))
    assert len(rms) == 1 + 16_000 // 512 and rms[10] == pytest.approx(math.sqrt(0.5), abs=1e-3) and centroid[10] == pytest.approx(1000, rel=0.02)
    silent = audio.frame_values(np.zeros(4000))
    assert not silent[0].any() and not silent[1].any()
    rows = spark.createDataFrame([("v", 0, [0.0] * 8000), ("v", 1, [0.1] * 1600), ("v", 2, [0.1] * 700), ("v", 3, None)], "video_id string, segment_index int, y array<float>")
    got = {r.segment_index: r for r in audio.audio_features(segs(spark, (0, 1), (1, 2), (2, 3), (3, 4), (4, 5)), rows).collect()}
    assert got[0].snr_estimate == 60 and got[1].snr_estimate is None and got[1].rms_mean > 0
    assert got[2].rms_mean is None and got[3].rms_mean is None and got[4].rms_mean is None


def test_faces(spark):
    kind = f"video_id string, segment_index int, height int, width int, boxes {visual.BOXES}"
    rows = [("v", 0, 100, 200, [(20.0, 0.0, 60.0, 50.0, 0.9)]), ("v", 0, 100, 200, []), ("v", 1, 0, 0, [])]
    got = {r.segment_index: r.face_area_ratio for r in visual.visual_features(segs(spark, (0, 1), (1, 2), (2, 3)), spark.createDataFrame(rows, kind)).collect()}
    assert got == {0: 0.1, 1: 0.0, 2: 0.0}
    boxes = F.array(F.struct(*[F.lit(v).alias(k) for k, v in (("x1", -0.5), ("y1", 0.1), ("x2", 1.5), ("y2", 0.6), ("conf", 0.5))]))
    (b,) = one(spark, visual.scaled(visual.confident(boxes), F.lit(100), F.lit(100)))
    assert (b.x1, b.y1, b.x2, b.y2) == (0, 10, 100, 60)


def test_detector_and_fallback(spark):
    frames = spark.createDataFrame([("v", 0, b"ok"), ("v", 1, None)], "video_id string, segment_index int, content binary")

    def broken():
        raise OSError

    rows = visual.detect_faces(frames, broken, lambda: lambda c: (10, 20, [(0, 0, 5, 5, 1)])).collect()
    assert len(rows) == 1 and rows[0].boxes[0].x2 == 5


def test_scoring(spark):
    assert one(spark, scoring.predicted(F.lit(0.19999999999999996), C.DECISION_THRESHOLD)) == 1
    rows = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    params = scoring.fit_scaler(rows, ["x"])
    assert [r.x for r in scoring.impute(scoring.scale(rows, params, ["x"]), ["x"]).collect()] == [-1, 1, 0]
    assert one(spark, scoring.imputed(F.lit(float("inf")))) == scoring.LARGEST and one(spark, scoring.imputed(F.lit(float("nan")))) == 0


def test_files(spark):
    local = spark.createDataFrame([("a.mp4", 1), ("b.mp4", 2), ("c.mp4", 3)], "name string, size bigint")
    remote = spark.createDataFrame([("a.mp4", 1), ("b.mp4", 9)], "name string, size bigint")
    wanted = spark.createDataFrame([(f"s3://b/x/{k}.mp4",) for k in "abcd"], "uri string")
    assert {r.name for r in files.to_fetch(wanted, local, remote).collect()} == {"b.mp4", "d.mp4"}
    v = spark.createDataFrame([("d/a.mp4",), ("d/b.mp4",)], "path string")
    t = spark.createDataFrame([("a_transcript_raw.json", 0), ("b_transcript_raw.json", 5)], "name string, size bigint")
    assert [r.path for r in files.to_transcribe(v, t).collect()] == ["d/a.mp4"]
    names = spark.createDataFrame([("lov1rp1.mp4",), ("plain.MP4",)], "video_name string")
    listing = spark.createDataFrame([("x/LOV1RP12_transcript_raw.json", "LOV1RP12_transcript_raw.json"), ("x/RW1RP1_transcript_raw.json", "RW1RP1_transcript_raw.json")], "path string, name string")
    got = {r.video_name: r.t for r in files.resolve(names, listing, "x/", files.TRANSCRIPT, "t").collect()}
    assert got == {"lov1rp1.mp4": "x/RW1RP1_transcript_raw.json", "plain.MP4": "x/plain_transcript_raw.json"}
    shot_files = spark.createDataFrame([("b_lov1rp1" + files.SHOTS,), ("a_rw1rp1" + files.SHOTS,), ("lov9rp9" + files.SHOTS,)], "name string")
    vids = spark.createDataFrame([("v/lov1rp1.mp4", "lov1rp1.mp4")], "path string, name string")
    assert [tuple(r) for r in files.available_videos(shot_files, vids).collect()] == [("a_rw1rp1" + files.SHOTS, "lov1rp1.mp4"), ("b_lov1rp1" + files.SHOTS, "lov1rp1.mp4")]


def inputs(spark):
    v = videos(spark, ("a", "lov1rp1.mp4", 20.0, 25.0), ("b", "lov2rp1.mp4", 10.0, 25.0), ("empty", "lov3rp1.mp4", 5.0, 25.0))
    s = spark.createDataFrame([("a", 0, 0.0), ("a", 1, 5.0), ("a", 2, 12.0), ("b", 0, 0.0)], "video_id string, shot_index int, shot_time double")
    w = spark.createDataFrame([("a", i, "w", 0.9, float(i), i + 0.5) for i in range(15)], WORDS)
    a = spark.createDataFrame([("a", 0.0, 6.0)], "video_id string, start_time double, end_time double")
    g = spark.createDataFrame([("a", 5.0, 12.0)], "video_id string, gt_start double, gt_end double")
    return plan.Inputs(v, s, w, a, truth=g)


def test_features_end_to_end(spark, tmp_path):
    given = inputs(spark)
    table = plan.features(given)
    assert table.columns == [*C.META_COLUMNS, *C.FEATURE_COLUMNS, C.LABEL] and len(table.columns) == 23
    assert {(r.video_name, r.segment_index): r.label for r in table.collect()} == {("lov1rp1.mp4", 0): 0, ("lov1rp1.mp4", 1): 1, ("lov1rp1.mp4", 2): 0, ("lov2rp1.mp4", 0): 0}
    assert plan.features(given, "lov2rp1.mp4").count() == 1 and plan.features(given, "lov3rp1.mp4").columns == table.columns
    skip = spark.createDataFrame([("lov1rp1.mp4",)], "video_name string")
    assert [r.video_name for r in plan.features_incremental(given, skip).collect()] == ["lov2rp1.mp4"]
    columns = ["word_count", "segment_duration", "speech_rate"]
    params = scoring.fit_scaler(table, columns)
    model = scoring.train_forest(scoring.impute(scoring.scale(table, params, columns), columns), columns, trees=5)
    model.write().overwrite().save(str(tmp_path / "m"))
    scored, ranges, docs = plan.infer(given, params, documents.load_model(spark, str(tmp_path / "m")), columns=columns)
    assert scored.count() == 4 and docs.count() == 2
    parsed = {r.video: json.loads(r.document) for r in docs.collect()}
    assert [s["index"] for s in parsed["lov1rp1.mp4"]["segments"]] == [0, 1, 2]
    assert sinks.summary(scored, ranges).first().n_segments == 4
    sinks.write_documents(docs, str(tmp_path / "out"))
    assert documents.read_whole(spark, str(tmp_path / "out" / "video_id=a"), "*.txt").count() == 1


def test_incremental_stream(spark, tmp_path):
    given = inputs(spark)
    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    run = lambda: incremental.build_on_arrival(spark, land, "video_id string, shot_index int, shot_time double", lambda b: segments.build_segments(b, given.videos), out, str(tmp_path / "cp")).awaitTermination()
    given.shots.where("video_id = 'a'").write.parquet(land)
    run()
    given.shots.where("video_id = 'b'").write.mode("append").parquet(land)
    run()
    assert sorted(r.video_id for r in spark.read.parquet(out).collect()) == ["a", "a", "a", "b"]


def wav(y, rate, width=2, channels=1):
    """A PCM file of values between -1 and 1."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels), w.setsampwidth(width), w.setframerate(rate)
        full = np.clip(np.repeat(y, channels), -1, 1) * (2 ** (8 * width - 1) - 1)
        raw = (np.round(full) + 128).astype(np.uint8).tobytes() if width == 1 else np.round(full).astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
        w.writeframes(raw)
    return out.getvalue()


@pytest.mark.parametrize("width", [1, 2, 3, 4])
@pytest.mark.parametrize(("rate", "channels"), [(48_000, 2), (44_100, 1), (16_000, 1), (8_000, 1)])
def test_wav_becomes_16_khz_mono(rate, channels, width):
    t = np.arange(rate) / rate
    told = files.decode_wav(wav(0.5 * np.sin(2 * math.pi * 1000 * t), rate, width, channels))
    assert told["duration"] == 1 and len(told["y"]) == 16_000
    rms, centroid = audio.frame_values(told["y"])
    assert centroid[15] == pytest.approx(1000, rel=0.35 if width == 1 else 0.03) and rms[15] == pytest.approx(0.5 * math.sqrt(0.5), rel=0.02)


def test_silent_wav_of_8_bits():
    y = files.decode_wav(wav(np.zeros(16_000), 16_000, 1))["y"]
    assert len(y) == 16_000 and not y.any()


def test_audio_of_segments_in_blocks(spark, tmp_path):
    rng = np.random.default_rng(0)
    y = rng.uniform(-1, 1, 50_000)
    (tmp_path / "a.wav").write_bytes(wav(y, 16_000, 4))
    content = spark.read.format("binaryFile").load(str(tmp_path))
    blocks = files.decode_audio(content, size=7000).select(F.lit("v").alias("video_id"), "block", "y")
    cut = audio.segment_samples(segs(spark, (0, 1), (1, 2.5), (2.5, 9), (9, 12), (5, 5)), blocks, size=7000).collect()
    got = {r.segment_index: np.array(r.y) for r in cut}
    assert set(got) == {0, 1, 2}
    for i, (a, b) in enumerate(((0, 16_000), (16_000, 40_000), (40_000, 50_000))):
        assert got[i] == pytest.approx(y[a:b], abs=1e-6)
    same = audio.blocks_of(blocks.groupBy("video_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "y"))), lambda x: x["y"])).alias("y")), 7000)
    assert sorted(map(str, same.collect())) == sorted(map(str, blocks.collect()))


def test_media_tools(spark):
    """The plans around ffprobe and ffmpeg, with a stand-in that answers their commands."""
    sound = wav(np.linspace(-1, 1, 40_000), 16_000)

    def start(command):
        if command[0] == "ffprobe":
            return 0, b"12.5\n"
        if "wav" in command:
            assert command[command.index("-ar") + 1] == "16000" and command[command.index("-ac") + 1] == "1"
            return 0, sound[:40] + b"\xff\xff\xff\xff" + sound[44:]  # as written to a pipe
        return (0, b"jpeg at " + command[command.index("-ss") + 1].encode()) if float(command[command.index("-ss") + 1]) < 2 else (1, b"")

    v = spark.createDataFrame([("v", "/x/v.mp4")], "video_id string, path string")
    assert media.durations(v, start).first().duration == 12.5
    blocks = media.audio(v, start, size=16_000).orderBy("block").collect()
    assert [len(b.y) for b in blocks] == [16_000, 16_000, 8_000] and blocks[0].y[0] == pytest.approx(-1, abs=1e-4)
    samples = segments.sample_times(segs(spark, (0, 3), (3, 6)))
    got = {(r.segment_index, r.sample_no): r.content for r in media.frames_at(samples, v, start).collect()}
    assert got[(0, 0)] == b"jpeg at 1.0" and got[(1, 1)] is None and len(got) == 4
    with pytest.raises(Exception, match="ffprobe ended with 1"):
        media.durations(v, lambda c: (1, b"")).collect()


def test_sampled_frames_to_face_ratio(spark):
    """Sample times, frames by index, detector, ratio; frames that are missing or unreadable have no say."""
    frames = spark.createDataFrame([("v", i, f"{i}".encode()) for i in range(0, 200, 2)], "video_id string, frame_index int, content binary")
    met = visual.frame_lookup(segments.sample_times(segs(spark, (0, 3), (3, 6), (6, 7))), frames, 25)
    assert sorted((r.segment_index, r.sample_no, r.frame_index) for r in met.collect()) == [(0, 1, 50), (1, 0, 100), (2, 0, 158)]

    def load():
        return lambda content: (100, 100, [(0, 0, int(content) / 2, 10, 1)]) if content != b"100" else None

    found = visual.detect_faces(met.select("video_id", "segment_index", "sample_no", "content"), load)
    got = {r.segment_index: r.face_area_ratio for r in visual.visual_features(segs(spark, (0, 3), (3, 6), (6, 7)), found).collect()}
    assert got == {0: 0.025, 1: 0.0, 2: 0.079}


def test_detected_boxes():
    found = np.array([[[[0, 1, 0.9, -0.1, 0.2, 0.5, 1.2], [0, 1, 0.4, 0, 0, 1, 1], [0, 1, 0.5, 0.25, 0, 1, 0.5]]]])
    assert detectors.boxes_in_pixels(found, 100, 200) == [(0, 20, 100, 100, 0.9), (50, 0, 200, 50, 0.5)]
    with pytest.raises((ImportError, FileNotFoundError)):
        detectors.network("/nowhere")()


def pixel_reader():
    """The reader as a closure, which reaches workers that cannot import this file."""
    return lambda content: np.frombuffer(content, np.uint8).reshape(2, 2) if len(content) == 4 else None


def test_frame_statistics_and_differences(spark):
    pixels = pixel_reader()
    frames = spark.createDataFrame([("v", 0, bytes([0, 0, 4, 4])), ("v", 1, b"bad"), ("v", 2, None)], "video_id string, frame_index int, content binary")
    got = {r.frame_index: (r.brightness, r.readable) for r in visual.frame_statistics(frames, pixels).collect()}
    assert got == {0: (2.0, True), 1: (None, False), 2: (None, False)}
    pairs = spark.createDataFrame([("v", 0, 4, bytes([0, 0, 0, 8]), bytes([4, 0, 0, 0]))], "video_id string, before_index int, after_index int, before binary, after binary")
    assert [tuple(r) for r in visual.frame_differences(pairs, pixels).collect()] == [("v", 0, 4, 3.0)]


def test_shots_from_frames_to_documents(spark):
    """Decoded frames to scores, cuts, flash filter and documents in one go; written videos are left out."""
    levels = [10] * 20 + [200] * 20 + [60] * 20
    levels[50] = 250  # a flash
    pixels = pixel_reader()
    frames = spark.createDataFrame([(v, i, bytes([x] * 4)) for v in ("v", "old") for i, x in enumerate(levels)], "video_id string, frame_index int, content binary")
    own = C.ShotSettings(min_scene_len=5)
    deltas = shots.frame_deltas(shots.frame_pairs(frames), lambda c: [pixels(c)] * 4)
    scores = {r.frame_index: r.score for r in shots.with_scores(deltas, own).where("video_id = 'v'").collect()}
    assert scores[0] == 0 and scores[20] == 190 and scores[21] == 0 and scores[50] == 190
    stats = visual.frame_statistics(frames, pixels)
    scored = shots.with_scores(deltas, own).join(stats, ["video_id", "frame_index"])
    at = lambda n, c: frames.select("video_id", F.col("frame_index").alias(n), F.col("content").alias(c))
    around = at("before_index", "before").join(at("after_index", "after"), "video_id").where("after_index - before_index = 4")
    v = videos(spark, ("v", "v.mp4", 3.0, 25.0), ("old", "old.mp4", 3.0, 25.0), ("still", "still.mp4", 3.0, 25.0))
    made = shots.detect_documents(scored, v, visual.frame_differences(around, pixels), spark.createDataFrame([("old",)], "video_id string"), own)
    got = {r.video_id: r.shot_times for r in documents.parse_shots(made).collect()}
    assert got == {"v": [0.0, 0.8, 1.6], "still": []}


def test_repeated_keys_in_documents(spark):
    """The last value of a repeated key counts, at the place of the first."""
    docs = ['{"v":{"timecodes_seconds":[1.0]},"v":{"timecodes_seconds":[2.0]}}', '{"a":{"timecodes_seconds":[1.0]},"b":{"timecodes_seconds":[2.0]},"a":{"timecodes_seconds":[3.0]}}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "video_id int, document string")
    assert {r.video_id: r.shot_times for r in documents.parse_shots(df).collect()} == {0: [2.0], 1: [3.0]}
    assert [list(json.loads(d).values()).pop(0)["timecodes_seconds"] for d in docs] == [[2.0], [3.0]]


def many_uris(n):
    """A URI document with repeated keys, ids given twice and entries that are no objects, as text, and its map by the reference's rules."""
    key = lambda i: f"u/lov{i % (n - 50)}rp1"
    value = lambda i: 3 if i % 97 == 0 else {"s3_uri": f"s3://b/RW{i // 6}rp2.mp4"} if i % 3 == 0 else {}
    pairs = [(key(i), value(i)) for i in range(n)]
    want = {}
    for uri, item in dict(pairs).items():
        if isinstance(item, dict):
            name = re.search(r"(?i)(?:LOV|RW)\d+RP\d+", item.get("s3_uri") or uri).group().upper()
            want["LOV" + name.removeprefix("RW").removeprefix("LOV")] = uri
    return "{" + ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in pairs) + "}", want


def test_time_of_a_uri_document_is_not_that_of_its_square(spark):
    document, want = many_uris(8000)
    began = time.perf_counter()
    got = {r.media_id: r.uri for r in documents.uri_map(spark.createDataFrame([(document,)], "document string")).collect()}
    took = time.perf_counter() - began
    assert got == want
    assert took < 20


def test_truth_of_many_uris(spark):
    document, uris = many_uris(8000)
    truth = json.dumps({u: [{"soundbite_start": i, "soundbite_end": i + 0.5}, {"soundbite_end": 1}] for i, u in enumerate(uris.values())})
    v = spark.createDataFrame([(k, f"clip_{k.lower()}.mp4") for k in uris], "video_id string, video_name string")
    text = lambda t: spark.createDataFrame([(t,)], "document string")
    began = time.perf_counter()
    got = sorted(map(tuple, documents.truth_of(v, documents.uri_map(text(document)), documents.ground_truth(text(truth))).collect()))
    took = time.perf_counter() - began
    assert got == sorted((k, i, i + 0.5) for i, k in enumerate(uris))
    assert took < 20


def test_malformed_truth_loses_no_other(spark):
    """By the reference an entry that cannot be read is skipped alone, and a repeated URI has its last list."""
    good = '{"soundbite_start":5,"soundbite_end":"6"}'
    text = f'{{"a":[3,"x",[1],null,{good}],"b":3,"c":{good},"d":[{good}],"d":[{{"soundbite_start":[1],"soundbite_end":6}},{{"soundbite_start":7,"soundbite_end":1e3}}],"e":null}}'
    got = documents.ground_truth(spark.createDataFrame([(text,), ("[]",), (None,)], "document string")).collect()
    assert sorted(map(tuple, got)) == [("a", 5.0, 6.0), ("d", 7.0, 1000.0)]


def test_two_videos_of_one_name_are_scored_once(spark):
    given = inputs(spark)
    v = videos(spark, ("a", "same.mp4", 20.0, 25.0), ("b", "same.mp4", 10.0, 25.0))
    params = spark.createDataFrame([("word_count", 0.0, 1.0)], "feature string, centre double, scale double")
    scored, _, docs = plan.infer(plan.Inputs(v, given.shots, given.words, given.audio_segments), params, scoring.Threshold(6.0), 0.5, ["word_count"])
    assert sorted((r.video_id, r.segment_index, r.predicted) for r in scored.collect()) == [("a", 0, 0), ("a", 1, 1), ("a", 2, 0), ("b", 0, 0)]
    assert docs.count() == 2 and set(C.REDUCED_FEATURE_COLUMNS) < set(C.FEATURE_COLUMNS)


def test_two_shot_files_give_rows_twice(spark):
    given = inputs(spark)
    listing = spark.createDataFrame([("a", "1.json"), ("a", "2.json"), ("b", "3.json")], "video_id string, shot_file string")
    own = spark.createDataFrame([("1.json", 0, 0.0), ("2.json", 0, 0.0), ("2.json", 1, 5.0), ("3.json", 0, 0.0)], "video_id string, shot_index int, shot_time double")
    rows = plan.features(plan.per_shot_file(plan.Inputs(given.videos, own, given.words, given.audio_segments, truth=given.truth), listing)).collect()
    assert sorted((r.video_name, r.segment_start, r.word_count) for r in rows) == [("lov1rp1.mp4", 0.0, 5.0), ("lov1rp1.mp4", 0.0, 15.0), ("lov1rp1.mp4", 5.0, 10.0), ("lov2rp1.mp4", 0.0, 0.0)]


def test_bucketed_labels_equal_plain_ones(spark):
    rng = np.random.default_rng(1)
    s = segs(spark, *[(a, a + d) for a, d in zip(rng.uniform(0, 100, 60), rng.uniform(-1, 12, 60))])
    t = spark.createDataFrame([("v", float(a), float(a + d)) for a, d in zip(rng.uniform(0, 100, 40), rng.uniform(-1, 9, 40))], "video_id string, gt_start double, gt_end double")
    key = lambda df: sorted(map(str, df.collect()))
    for width in (0.7, 5.0, 300.0):
        assert key(labels.label_segments(s, t, width)) == key(labels.label_segments(s, t)) and key(labels.positives(s, t, width)) == key(labels.positives(s, t))


def test_min_gap_over_many_points(spark):
    rng = np.random.default_rng(2)
    at = np.unique(rng.integers(0, 20_000, 3000)).tolist()
    kept = []
    for x in at:
        if not kept or x - kept[-1] >= 7:
            kept.append(x)
    p = spark.createDataFrame([("v", x) for x in at], "video_id string, at int")
    assert len(kept) > 1000 and sorted(r["at"] for r in shots.greedy_min_gap(p, "at", 7).collect()) == kept


def store():
    """A factory of stand-ins for the object store and the transcription service."""

    class Store:
        sizes = {"k/a.mp4": 3, "k/b.mp4": 5, "k/c.mp4": 4}

        def head_object(self, Bucket, Key):
            return {"ContentLength": self.sizes[Key]}

        def download_file(self, bucket, key, path):
            with open(path, "wb") as out:
                out.write(b"x" * self.sizes[key])

        def start_transcription_job(self, **request):
            assert request["MediaFormat"] == "mp4" and request["IdentifyLanguage"]
            self.state = iter(["QUEUED", "FAILED" if "bad" in request["Media"]["MediaFileUri"] else "COMPLETED"])

        def get_transcription_job(self, TranscriptionJobName):
            return {"TranscriptionJob": {"TranscriptionJobStatus": next(self.state), "Transcript": {"TranscriptFileUri": "u"}, "FailureReason": "no speech"}}

    return Store


def test_fetch_and_transcribe(spark, tmp_path):
    Store = store()
    (tmp_path / "a.mp4").write_bytes(b"abc")
    (tmp_path / "b.mp4").write_bytes(b"old")
    (tmp_path / "x.mp4").write_bytes(b"kept")
    uris = spark.createDataFrame([(f"s3://bucket/k/{n}.mp4",) for n in "abcx"], "uri string")
    assert {r.name: r.size for r in remote.remote_sizes(uris, Store).collect()} == {"a.mp4": 3, "b.mp4": 5, "c.mp4": 4, "x.mp4": None}
    got = {r.path.rpartition("/")[2]: r.fetched for r in remote.fetch(uris, str(tmp_path), Store).collect()}
    assert got == {"a.mp4": False, "b.mp4": True, "c.mp4": True, "x.mp4": False}
    assert sorted((p.name, p.stat().st_size) for p in tmp_path.iterdir()) == [("a.mp4", 3), ("b.mp4", 5), ("c.mp4", 4), ("x.mp4", 4)]
    said = remote.transcribe(uris.limit(1), Store, lambda u: '{"results":{"x":"é"}}'.encode(), 0.0).first()
    assert said.file_name == "a_transcript_raw.json" and said.document == '{\n  "results": {\n    "x": "é"\n  }\n}'
    with pytest.raises(Exception, match="no speech"):
        remote.transcribe(spark.createDataFrame([("s3://b/bad.mp4",)], "uri string"), Store, lambda u: b"{}", 0.0).collect()
    written = sinks.transcript_documents(spark.createDataFrame([("v", "d/v.mp4", '{"a":[1]}')], "video_id string, path string, document string")).first()
    assert (written.file_name, json.loads(written.document)) == ("v_transcript_raw.json", {"a": [1]})


def test_names_of_files(spark):
    assert one(spark, ids.frame_file(F.lit("d/v.mp4"), F.lit(7), F.lit(1))) == "v_seg_0007_f1.jpg"
    assert one(spark, ids.prediction_file(F.lit("d/v.mp4"))) == "v_soundbites.json" and one(spark, ids.transcript_file(F.lit("v.mp4"))) == "v_transcript_raw.json"
    assert one(spark, ids.job_name()).startswith("transcribe-") and len(one(spark, ids.job_name())) == 19
    assert one(spark, sinks.range_line(F.lit(1.0), F.lit(2.5), F.lit(0.25))) == "1.000 - 2.500 (0.2500)"


def test_frames_and_metadata(spark, tmp_path):
    rows = spark.createDataFrame([("v.mp4", 3, 0, b"jpeg")], "video_name string, segment_index int, sample_no int, content binary")
    sinks.write_frames(rows, str(tmp_path / "frames"))
    assert spark.read.parquet(str(tmp_path / "frames")).first().file_name == "v_seg_0003_f0.jpg"
    (tmp_path / "meta.json").write_text('{"feature_columns": ["word_count"]}')
    told = documents.model_metadata(spark, str(tmp_path / "meta.json"))
    assert told == {"decision_threshold": 0.5, "feature_columns": ["word_count"]}


def test_speech_sessions(spark):
    words = spark.createDataFrame([("v", "2024-01-01 00:00:00"), ("v", "2024-01-01 00:00:20"), ("v", "2024-01-01 00:02:00")], "video_id string, ts string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r.n_words for r in incremental.speech_sessions(words).collect()) == [1, 2]
