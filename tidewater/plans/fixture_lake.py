"""The fixture lake: three daily ingest+load runs over landing derived from ``orders``.

Built once per (shared root, sf folder) and reused by every registered
query; a ``_BUILT`` marker is written last, so an interrupted build is
simply redone (all writes are deterministic and keyed).
"""

from __future__ import annotations

import inspect
import os
import threading
import uuid
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import SparkSession

from tidewater.plans import lake as lake_tables
from tidewater.plans import loader, manifests
from tidewater.plans.lake import Lake
from tidewater.plans.loader import load_competitions, load_matches
from tidewater.session import configure, digest, scratch_dir
from tidewater.sources import fixture, fs, landing, tables
from tidewater.sources.fixture import FIXTURE_EPOCH, SNAPSHOTS_PER_MATCH, land_day

FIXTURE_VERSION = "7"
LOAD_HOUR = "02:00:00"


@dataclass
class FixtureLake:
    root: str
    landing: str
    lake: Lake


def load_time(day: int) -> str:
    d = date.fromisoformat(FIXTURE_EPOCH) + timedelta(days=day)
    return f"{d.isoformat()} {LOAD_HOUR}"


def fixture_root(spark: SparkSession, sf_dir: str, tag: str = "fx") -> str:
    """The fixture's folder, built or not: it names the session's shared root and the tables' content."""
    # TIDEWATER_FIXTURE_TAG forces a fresh build (the bench times the build itself)
    generation = os.environ.get("TIDEWATER_FIXTURE_TAG", "")
    return scratch_dir(spark, tag, digest(_content(spark, sf_dir) + _code() + FIXTURE_VERSION + generation))


def _content(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the tables the fixture is derived from."""
    return "|".join(fs.stamp(spark, f"{sf_dir}/{t}.parquet") for t in ("orders", "region"))


def _code() -> str:
    """The modules that decide what the built lake holds."""
    modules = (fixture, landing, loader, manifests, lake_tables, tables)
    return digest("".join(inspect.getsource(m) for m in modules))


def _at(spark: SparkSession, root: str) -> FixtureLake:
    return FixtureLake(root, f"{root}/landing", Lake(spark, f"{root}/lake"))


def _built(spark: SparkSession, root: str) -> FixtureLake | None:
    marker = f"{root}/_BUILT"
    if not fs.exists(spark, marker):
        return None
    sub = fs.read_text(spark, marker).strip()
    return _at(spark, f"{root}/{sub}" if sub else root)


_BUILD_LOCK = threading.Lock()


def fixture_lake(spark: SparkSession, sf_dir: str, tag: str = "fx") -> FixtureLake:
    """The built fixture lake; built on first use.

    Each build goes to a fresh sub-folder and ``_BUILT`` (written last) names
    it, so an interrupted build is never resumed half-way.
    """
    configure(spark)
    root = fixture_root(spark, sf_dir, tag)
    fx = _built(spark, root)
    if fx is not None:
        return fx
    with _BUILD_LOCK:  # queries of one process may be called from several threads
        fx = _built(spark, root)
        if fx is not None:
            return fx
        build = f"build-{uuid.uuid4().hex[:12]}"
        _build(spark, sf_dir, _at(spark, f"{root}/{build}"))
        fs.write_text(spark, f"{root}/_BUILT", build)
        return _built(spark, root)


def _build(spark: SparkSession, sf_dir: str, fx: FixtureLake) -> None:
    for day in range(SNAPSHOTS_PER_MATCH):
        land_day(spark, sf_dir, fx.landing, day)
        load_matches(spark, fx.landing, fx.lake, "matches", loaded_at=load_time(day))
    load_competitions(spark, fx.landing, fx.lake)
