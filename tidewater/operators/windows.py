"""Date-window operators: rolling request window, backfill chunks, coverage gaps.

The ingest scripts compute request windows on one machine; here the same
date arithmetic selects and labels rows of any table, all with built-in
date functions (no driver-side loops over days).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# --- fixed values: window parameters of the ingest jobs ---
DAYS_BACK, DAYS_FORWARD = 1, 7
CHUNK_MIN, CHUNK_MAX, CHUNK_DEFAULT = 1, 60, 30
# --- end fixed values ---


def _d(x: str | date) -> Column:
    return F.lit(str(x)).cast("date")


def _day_range(df: DataFrame, ts: str, lo: Column, hi: Column) -> Column:
    """``to_date(ts)`` in [lo, hi], written as a range on the raw column
    (ts >= lo and ts < hi + 1 day) so parquet can push it into the scan."""
    t = df.schema[ts].dataType
    c = F.col(ts)
    if isinstance(t, T.DateType):
        return c.between(lo, hi)
    kind = "timestamp_ntz" if isinstance(t, T.TimestampNTZType) else "timestamp"
    return (c >= lo.cast(kind)) & (c < F.date_add(hi, 1).cast(kind))


def rolling_window_filter(df: DataFrame, ts: str, as_of: str | date, back: int = DAYS_BACK,
                          fwd: int = DAYS_FORWARD, codes: str | None = None, code_col: str | None = None) -> DataFrame:
    """Rows whose day lies in [as_of - back, as_of + fwd] (inclusive), optionally
    restricted to a comma-separated code list (blank entries ignored)."""
    lo, hi = F.date_sub(_d(as_of), back), F.date_add(_d(as_of), fwd)
    out = df.where(_day_range(df, ts, lo, hi))
    if codes is not None and code_col is not None:
        # a constant list becomes IN (...), which parquet can push down;
        # split_codes does the same parse for a list held in a column
        wanted = [c.strip() for c in codes.split(",") if c.strip()]
        out = out.where(F.col(code_col).isin(wanted))
    return out.withColumn("window_from", lo).withColumn("window_to", hi)


def validate_chunking(start: str | date, end: str | date, n: int) -> None:
    if date.fromisoformat(str(start)) > date.fromisoformat(str(end)):
        raise ValueError("start must be <= end")
    if n < CHUNK_MIN or n > CHUNK_MAX:
        raise ValueError(f"chunk days must be between {CHUNK_MIN} and {CHUNK_MAX}")


def assign_backfill_chunk(df: DataFrame, ts: str, start: str | date, end: str | date,
                          n: int = CHUNK_DEFAULT) -> DataFrame:
    """Label each row with its inclusive chunk [date_from, date_to] of ``n`` days
    starting at ``start``; the last chunk is cut at ``end``; rows outside dropped."""
    validate_chunking(start, end, n)
    day = F.to_date(F.col(ts))
    inside = df.where(_day_range(df, ts, _d(start), _d(end)))
    chunk = F.floor(F.datediff(day, _d(start)) / n).cast("int")
    date_from = F.date_add(_d(start), chunk * n)
    return (inside.withColumn("chunk_no", chunk)
            .withColumn("date_from", date_from)
            .withColumn("date_to", F.least(F.date_add(date_from, n - 1), _d(end))))


def planned_chunks(keys: DataFrame, start: str | date, end: str | date, n: int = CHUNK_DEFAULT) -> DataFrame:
    """Every chunk the backfill plans, per key row: key columns + date_from, date_to."""
    validate_chunking(start, end, n)
    starts = F.sequence(_d(start), _d(end), F.expr(f"INTERVAL {n} DAYS"))
    planned = keys.select("*", F.explode(starts).alias("date_from"))
    return planned.withColumn("date_to", F.least(F.date_add("date_from", n - 1), _d(end)))


def coverage_islands(loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Maximal islands of the loaded windows (date_from, date_to inclusive): overlapping and adjacent ones are one.

    A sweep by key in the order of beginnings: a window that begins after all before it have ended, and not on
    the next day, begins an island.  Windows of one beginning are one row before the shuffle's sort.
    """
    rows = loaded.where("date_from <= date_to").groupBy(*keys, "date_from").agg(F.max("date_to").alias("date_to"))
    sweep = Window.partitionBy(*keys).orderBy("date_from")
    reach = F.max("date_to").over(sweep.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("date_from") > F.date_add(reach, 1)), 1).otherwise(0)
    numbered = rows.withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(sweep))
    return numbered.groupBy(*keys, "_island").agg(F.min("date_from").alias("date_from"), F.max("date_to").alias("date_to")).drop("_island")


def uncovered(wanted: DataFrame, loaded: DataFrame, keys: list[str], start: str | date, end: str | date) -> DataFrame:
    """Maximal gaps, within [start, end], of the loaded windows of each key of ``wanted``."""
    lo, hi = _d(start), _d(end)
    inside = loaded.where((F.col("date_to") >= lo) & (F.col("date_from") <= hi)).select(
        *keys, F.greatest("date_from", lo).alias("date_from"), F.least("date_to", hi).alias("date_to"))
    # a window just before and one just after bound every key's range
    edges = F.array(*[F.struct(d.alias("date_from"), d.alias("date_to")) for d in (F.date_sub(lo, 1), F.date_add(hi, 1))])
    bounds = wanted.select(*keys).distinct().select(*keys, F.inline(edges))
    islands = coverage_islands(bounds.unionByName(inside.join(wanted.select(*keys).distinct(), keys, "left_semi")), keys)
    following = F.lead("date_from").over(Window.partitionBy(*keys).orderBy("date_from"))
    gaps = islands.select(*keys, F.date_add("date_to", 1).alias("date_from"), F.date_sub(following, 1).alias("date_to"))
    return gaps.where("date_from <= date_to")


def coverage_gaps(planned: DataFrame, loaded: DataFrame, keys: list[str], start: str | date, end: str | date) -> DataFrame:
    """The parts of planned chunks that no loaded window covers, however the loaded windows were cut:
    the chunk, and missing_from, missing_to (a chunk may miss several parts)."""
    gaps = uncovered(planned, loaded, keys, start, end).withColumnsRenamed({"date_from": "gap_from", "date_to": "gap_to"})
    both = planned.join(gaps, keys).where("gap_from <= date_to AND gap_to >= date_from")
    return both.select(*planned.columns, F.greatest("date_from", "gap_from").alias("missing_from"), F.least("date_to", "gap_to").alias("missing_to"))
