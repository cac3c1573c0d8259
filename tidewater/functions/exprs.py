"""Built-in column expressions shared by the plans (all JVM-side, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: landing key patterns (must match the landed key layout) ---
# run_id ends the key in the object layout (`run_id=<id>.json`,
# `run_id=<id>.manifest.json`) and is a folder in the Spark-written layout
# (`run_id=<id>/part-....json`); both parse.
RUN_ID_RE = r"run_id=([a-f0-9\-]+)(?:/|\.(?:manifest\.)?json$)"
DT_RE = r"dt=(\d{4}-\d{2}-\d{2})"
COMPETITION_RE = r"competition=([^/]+)/"
DATE_FROM_RE = r"dateFrom=(\d{4}-\d{2}-\d{2})"
DATE_TO_RE = r"dateTo=(\d{4}-\d{2}-\d{2})"
DATA_SUFFIX = ".json"
MANIFEST_SUFFIX = ".manifest.json"
# --- end fixed values ---


def regex_group(col: Column | str, pattern: str) -> Column:
    """First capture group of the first match, NULL when there is none."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def is_data_key(key: Column) -> Column:
    return key.endswith(DATA_SUFFIX) & ~key.endswith(MANIFEST_SUFFIX)


def is_manifest_key(key: Column) -> Column:
    return key.endswith(MANIFEST_SUFFIX)


def manifest_key_for(key: Column) -> Column:
    """Data key -> expected manifest key; only the trailing suffix is replaced."""
    return F.regexp_replace(key, r"\.json$", MANIFEST_SUFFIX)


def falsy_or(a: Column, b: Column) -> Column:
    """Python's ``a or b`` for strings: NULL and '' both fall through."""
    return F.coalesce(F.nullif(a, F.lit("")), b)


def relative_key(path: Column, anchor: str = "endpoint=") -> Column:
    """Object key of a file: the path from the first ``endpoint=`` folder on."""
    return F.regexp_extract(path, r"(" + anchor + r".*)$", 1)


def file_key(path: Column) -> Column:
    """Object key of a file path as the file source reports it in ``_metadata``: URL-encoded, unlike a listing."""
    return relative_key(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


def landing_folder(path: Column) -> Column:
    """The folder of an object's landing day, or its own folder where the key has none."""
    day = F.regexp_extract(path, r"^(.*/dt=[^/]+)/", 1)
    return F.when(day != "", day).otherwise(F.regexp_extract(path, r"^(.*)/[^/]*$", 1))


def split_codes(s: Column) -> Column:
    """'PL, SA,,BL1 ' -> ['PL','SA','BL1']: split on comma, trim, drop blanks."""
    return F.filter(F.transform(F.split(s, ","), lambda x: F.trim(x)), lambda x: x != "")
