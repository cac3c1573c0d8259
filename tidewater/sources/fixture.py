"""Deterministic landing fixture derived from the driver's ``orders`` table.

One order is one *snapshot* of a match; three consecutive order keys are
three snapshots of the same match landed on three consecutive days.  All
fields are plain arithmetic on ``orders`` columns, so a SQL oracle can
compute every downstream answer straight from ``orders`` without sharing
any code with the Spark path (landing JSON -> variant -> models).

The documents are built by Spark (``to_json`` over bounded groups) and each
executor writes its own documents under deterministic keys, so a retried
task rewrites identical objects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources import fs

# --- fixed values of the fixture (FIXTURES.md section 4) ---
COMPETITION_CODES = ["PL", "SA", "BL1", "PD", "FL1"]
STATUS_BY_ORDERSTATUS = {"F": "FINISHED", "O": "SCHEDULED", "P": "IN_PLAY"}
FIXTURE_EPOCH = "2024-01-01"
SNAPSHOTS_PER_MATCH = 3
DOC_MAX_MATCHES = 2000           # a landed document never holds more matches
NO_MANIFEST_COMPETITION = "FL1"  # its manifests are never landed
MISCOUNTED = (3, 2)              # (competition index, snapshot) with record_count + 1
BUCKET = "bronze"
# planted data faults
ABANDONED_MOD, ABANDONED_REM = 211, 17    # status outside the accepted list
NO_KICKOFF_MOD, NO_KICKOFF_REM = 173, 5   # snapshot without utcDate
NO_HOME_MOD, NO_HOME_REM = 331, 29        # match without homeTeam
NO_WINNER_MOD, NO_WINNER_REM = 50, 7      # finished match without winner
# --- end fixed values ---

# matches of one task that builds documents (one order is one of them)
TASK_MATCHES = 32 * DOC_MAX_MATCHES


def _code(comp: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in COMPETITION_CODES]), (comp + 1).cast("int"))


def _team(team_id: Column) -> Column:
    return F.struct(
        team_id.alias("id"),
        F.concat(F.lit("Team "), team_id.cast("string")).alias("name"),
        F.concat(F.lit("T"), team_id.cast("string")).alias("shortName"),
        F.lit(None).cast("string").alias("tla"),
        F.lit(None).cast("string").alias("crest"),
    )


def snapshots(orders: DataFrame) -> DataFrame:
    """One row per match snapshot with the API-shaped ``m`` struct, those of a document in one task.

    An order's few columns travel, not the struct made of them, and the number of tasks follows the orders: it
    is given, since what a task makes of its rows is many times their size.
    """
    tasks = max(-(-orders.count() // TASK_MATCHES), orders.sparkSession.sparkContext.defaultParallelism)
    k = F.col("o_orderkey")
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    o = (
        o.withColumn("match_id", F.floor(k / 3))
        .withColumn("snap_no", (k % 3).cast("int"))
        .withColumn("comp", F.col("match_id") % 5)
        .withColumn("h", F.floor(F.col("match_id") / 5) % 20)
        .withColumn("a", (F.col("h") + 1 + F.floor(F.col("match_id") / 100) % 19) % 20)
        .withColumn("home_id", F.col("comp") * 100 + F.col("h"))
        .withColumn("away_id", F.col("comp") * 100 + F.col("a"))
        .withColumn(
            "status",
            F.when(F.col("match_id") % ABANDONED_MOD == ABANDONED_REM, F.lit("ABANDONED")).otherwise(
                F.element_at(F.create_map(*[F.lit(x) for kv in STATUS_BY_ORDERSTATUS.items() for x in kv]),
                             F.col("o_orderstatus"))),
        )
        .withColumn("finished", F.col("o_orderstatus") == "F")
        .withColumn("hg", F.when(F.col("finished"), F.col("o_custkey") % 5))
        .withColumn("ag", F.when(F.col("finished"), F.floor(F.col("o_totalprice")) % 4))
        .withColumn("dt", F.date_add(F.lit(FIXTURE_EPOCH).cast("date"), F.col("snap_no")))
        .withColumn("shard", F.floor(F.floor(F.col("match_id") / 5) / DOC_MAX_MATCHES))
        .repartition(tasks, "comp", "snap_no", "dt", "shard")
    )
    utc = F.timestamp_add("SECOND", k % 86400, F.col("o_orderdate").cast("timestamp_ntz"))
    last_upd = F.timestamp_add("SECOND", k, F.lit(FIXTURE_EPOCH).cast("timestamp_ntz"))
    winner = (
        F.when(~F.col("finished") | (F.col("match_id") % NO_WINNER_MOD == NO_WINNER_REM), F.lit(None))
        .when(F.col("hg") > F.col("ag"), "HOME_TEAM")
        .when(F.col("hg") == F.col("ag"), "DRAW")
        .otherwise("AWAY_TEAM")
    )
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    comp = F.col("comp")
    m = F.struct(
        F.col("match_id").alias("id"),
        F.when(k % NO_KICKOFF_MOD != NO_KICKOFF_REM, F.date_format(utc, iso)).alias("utcDate"),
        F.col("status"),
        F.lit("REGULAR_SEASON").alias("stage"),
        F.lit(None).cast("string").alias("group"),
        (F.col("match_id") % 38 + 1).alias("matchday"),
        F.date_format(last_upd, iso).alias("lastUpdated"),
        F.struct(
            (comp + 2000).alias("id"),
            _code(comp).alias("code"),
            F.concat(F.lit("Competition "), comp.cast("string")).alias("name"),
            F.lit("LEAGUE").alias("type"),
        ).alias("competition"),
        F.struct(
            (comp * 10 + 1 + F.floor(F.col("match_id") / 250) % 2).alias("id"),
            F.lit("1995-01-01").alias("startDate"),
            F.lit("2004-12-31").alias("endDate"),
            F.lit(None).cast("bigint").alias("currentMatchday"),
        ).alias("season"),
        F.when(F.col("match_id") % NO_HOME_MOD != NO_HOME_REM, _team(F.col("home_id"))).alias("homeTeam"),
        _team(F.col("away_id")).alias("awayTeam"),
        F.struct(
            winner.alias("winner"),
            F.lit("REGULAR").alias("duration"),
            F.struct(F.col("hg").alias("home"), F.col("ag").alias("away")).alias("fullTime"),
            F.struct(F.floor(F.col("hg") / 2).alias("home"), F.floor(F.col("ag") / 2).alias("away")).alias("halfTime"),
        ).alias("score"),
    )
    return o.select("match_id", "snap_no", "comp", "dt", "shard", m.alias("m"))


def documents(snaps: DataFrame, endpoint: str = "matches") -> DataFrame:
    """Group snapshots into landed documents: one per (competition, day, shard).

    A group holds at most DOC_MAX_MATCHES matches by construction, so
    ``collect_list`` never gathers an unbounded group.
    """
    docs = snaps.groupBy("comp", "snap_no", "dt", "shard").agg(
        F.sort_array(F.collect_list(F.struct("match_id", "m"))).alias("ms")
    )
    code = _code(F.col("comp"))
    run_id = F.concat_ws("-", F.concat(F.lit("0"), F.col("comp").cast("string")),
                         F.col("snap_no").cast("string"), F.col("shard").cast("string"))
    date_from = F.date_sub("dt", 1).cast("string")
    date_to = F.date_add("dt", 7).cast("string")
    key = F.concat(
        F.lit(f"endpoint={endpoint}/competition="), code, F.lit("/dateFrom="), date_from, F.lit("/dateTo="), date_to,
        F.lit("/dt="), F.col("dt").cast("string"), F.lit("/run_id="), run_id, F.lit(".json"),
    )
    n = F.size("ms")
    miscount = (F.col("comp") == MISCOUNTED[0]) & (F.col("snap_no") == MISCOUNTED[1])
    manifest = F.to_json(F.struct(
        run_id.alias("run_id"),
        F.lit(endpoint).alias("endpoint"),
        code.alias("competition"),
        F.struct(date_from.alias("dateFrom"), date_to.alias("dateTo")).alias("params"),
        F.col("dt").cast("string").alias("dt_partition"),
        F.concat(F.col("dt").cast("string"), F.lit("T01:00:00+00:00")).alias("fetched_at_utc"),
        (n + F.when(miscount, 1).otherwise(0)).alias("record_count"),
        F.lit(BUCKET).alias("bucket"),
        key.alias("data_key"),
    ))
    body = F.to_json(F.struct(F.transform("ms", lambda x: x["m"]).alias("matches")))
    data = F.struct(key.alias("key"), body.alias("body"))
    man = F.struct(F.regexp_replace(key, r"\.json$", ".manifest.json").alias("key"), manifest.alias("body"))
    # both from one grouping of the snapshots
    pair = F.when(code != NO_MANIFEST_COMPETITION, F.array(data, man)).otherwise(F.array(data))
    return docs.select("snap_no", F.inline(pair))


def landing_rows(snaps: DataFrame) -> DataFrame:
    """Documents as rows for the partitioned landing writer: key fields + ``matches``."""
    docs = snaps.groupBy("comp", "snap_no", "dt", "shard").agg(
        F.sort_array(F.collect_list(F.struct("match_id", "m"))).alias("ms"))
    run_id = F.concat_ws("-", F.concat(F.lit("0"), F.col("comp").cast("string")),
                         F.col("snap_no").cast("string"), F.col("shard").cast("string"))
    return docs.select(
        F.lit("matches").alias("endpoint"),
        _code(F.col("comp")).alias("competition"),
        F.date_sub("dt", 1).cast("string").alias("dateFrom"),
        F.date_add("dt", 7).cast("string").alias("dateTo"),
        F.col("dt").cast("string").alias("dt"),
        run_id.alias("run_id"),
        F.transform("ms", lambda x: x["m"]).alias("matches"),
    )


def competitions_documents(region: DataFrame, days: int = SNAPSHOTS_PER_MATCH) -> DataFrame:
    """Competitions documents per landing day, listing every region as a competition
    (at most DOC_MAX_MATCHES entries per document, like the match documents)."""
    rows = region.select(
        (F.col("r_regionkey").cast("bigint") + 2000).alias("id"),
        F.upper(F.substring("r_name", 1, 3)).alias("code"),
        F.col("r_name").alias("name"),
        F.floor(F.col("r_regionkey") / DOC_MAX_MATCHES).alias("shard"),
    )
    docs = rows.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("id", "code", "name"))).alias("competitions"))
    day = F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("snap_no")
    d = docs.select(day, "shard", "competitions").withColumn(
        "dt", F.date_add(F.lit(FIXTURE_EPOCH).cast("date"), F.col("snap_no")))
    key = F.concat(F.lit("endpoint=competitions/dt="), F.col("dt").cast("string"),
                   F.lit("/run_id=0c-"), F.col("snap_no").cast("string"), F.lit("-"),
                   F.col("shard").cast("string"), F.lit(".json"))
    return d.select("snap_no", key.alias("key"), F.to_json(F.struct("competitions")).alias("body"))


def write_objects(docs: DataFrame, root: str) -> dict:
    """Each task writes its own documents as whole objects ``root/key``.

    Documents reach a task's Python side a few at a time: an Arrow batch of them is many megabytes, and is held there
    several times over.  The task function is self-contained (pyarrow only), so executors need nothing but
    pyspark's own dependencies to run it.
    """
    root = fs.qualify(docs.sparkSession, root)  # the same folder for Spark and for the tasks

    def put(rows):
        from pyarrow import fs as pafs

        if root.startswith("file:"):
            base = root[len("file:"):]
            while base.startswith("//"):
                base = base[1:]
            filesystem = pafs.LocalFileSystem()
        else:
            filesystem, base = pafs.FileSystem.from_uri(root)
        objects = size = 0
        for key, body in rows:
            data = body.encode("utf-8")
            path = f"{base}/{key}"
            filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with filesystem.open_output_stream(path) as out:  # a retried task rewrites the same bytes
                out.write(data)
            objects, size = objects + 1, size + len(data)
        yield objects, size

    done = docs.select("key", "body").rdd.mapPartitions(put)
    objects, size = done.fold((0, 0), lambda a, b: (a[0] + b[0], a[1] + b[1]))
    return {"objects": objects, "bytes": size}


def land_day(spark: SparkSession, sf_dir: str, landing: str, day: int) -> dict:
    """Land the documents of one ingest day (snapshot ``day``)."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    docs = documents(snapshots(orders)).unionByName(competitions_documents(region))
    return write_objects(docs.where(F.col("snap_no") == day), landing)
