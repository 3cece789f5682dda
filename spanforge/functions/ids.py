"""Ids, names and keys out of paths and URIs, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: how a media id looks inside a name.
MEDIA_ID = r"(?i)(?:LOV|RW)\d+RP\d+"
S3_URI = r"(?s)^s3://([^/]+)/(.+)$"


def media_id(name: Column) -> Column:
    """The first id in a name, upper-cased and with its RW prefix as LOV; null without one."""
    return F.nullif(F.regexp_replace(F.upper(F.regexp_extract(name, MEDIA_ID, 0)), "^RW", "LOV"), F.lit(""))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """Base name without its last extension; a leading dot is no extension."""
    return F.regexp_replace(base_name(path), r"(?<=[^.])\.[^.]*$", "")


def s3_bucket(uri: Column) -> Column:
    """Bucket of an s3:// URI; empty where the URI is not one with a bucket and a key."""
    return F.regexp_extract(uri, S3_URI, 1)


def s3_key(uri: Column) -> Column:
    return F.regexp_extract(uri, S3_URI, 2)


def checked_s3(uri: Column) -> Column:
    """bucket and key; a malformed URI fails the query."""
    bad = F.raise_error(F.concat(F.lit("not an s3 URI with bucket and key: "), F.coalesce(uri, F.lit("null"))))
    ok = uri.rlike(S3_URI)
    return F.struct(F.when(ok, s3_bucket(uri)).otherwise(bad.cast("string")).alias("bucket"), F.when(ok, s3_key(uri)).otherwise(bad.cast("string")).alias("key"))


def frame_file(name: Column, segment_index: Column, sample: Column) -> Column:
    return F.format_string("%s_seg_%04d_f%d.jpg", stem(name), segment_index, sample)


def transcript_file(path: Column) -> Column:
    return F.concat(stem(path), F.lit("_transcript_raw.json"))


def prediction_file(path: Column) -> Column:
    return F.concat(stem(path), F.lit("_soundbites.json"))


def job_name() -> Column:
    """A fresh name for an external transcription job."""
    return F.concat(F.lit("transcribe-"), F.substring(F.regexp_replace(F.uuid(), "-", ""), 1, 8))
