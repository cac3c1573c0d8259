"""What a load lists, opens and counts."""

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, data_key, match, put
from tidewater.functions import exprs as X
from tidewater.plans.lake import Lake
from tidewater.plans.loader import append_new, load_matches, raw_matches_rows
from tidewater.plans.manifests import landing_pairs, manifest_reconcile
from tidewater.sources import landing as L
from tidewater.sources.fixture import documents, snapshots


def _lake(spark, tmp_path):
    return str(tmp_path / "landing"), Lake(spark, str(tmp_path / "lake"))


def opened(df):
    """Files that the scan of a text read opened."""
    df.collect()
    todo, files = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if "AdaptiveSparkPlan" in name:
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            if name.startswith("Scan text"):
                files += node.metrics().apply("numFiles").value()
            todo += [node.children().apply(k) for k in range(node.children().size())]
    return files


def test_old_days_are_not_listed(spark, tmp_path, monkeypatch):
    land, lake = _lake(spark, tmp_path)
    for k in range(1, 29):
        put(land, data_key(day=f"2024-01-{k:02d}", run=f"0{k}"), {"matches": [match(k)]})
    first = load_matches(spark, land, lake, look_back=3)
    assert first["files_discovered"] == first["data_files_loaded"] == 28  # nothing seen before: all days
    # a new day, one late object inside the look-back and one before it
    put(land, data_key(day="2024-01-29", run="0a"), {"matches": [match(50)]})
    put(land, data_key(day="2024-01-26", run="0b"), {"matches": [match(51)]})
    put(land, data_key(day="2024-01-09", run="0c"), {"matches": [match(52)]})
    entered = []
    folders = L.fs.folders
    monkeypatch.setattr(L.fs, "folders", lambda spark, path: entered.append(path) or folders(spark, path))
    m = load_matches(spark, land, lake, look_back=3)
    assert (m["files_discovered"], m["files_to_load"]) == (6, 2)  # days 25 to 29
    # request windows begin a day before: older ones are not entered
    assert len([p for p in entered if "dateFrom=" in p]) == 2 * 5 and not any("dateFrom=2024-01-08" in p for p in entered)
    assert load_matches(spark, land, lake, look_back=3)["files_to_load"] == 0
    # the full mode finds the one that came too late
    full = load_matches(spark, land, lake)
    assert (full["files_discovered"], full["files_to_load"]) == (31, 1)
    assert lake.raw_matches.read().count() == 31


def test_backfill_windows_are_pruned_by_landing_day_alone(spark, tmp_path):
    land, lake = _lake(spark, tmp_path)
    key = "endpoint=matches_backfill/competition=PL/dateFrom=20{0}-01-01/dateTo=20{0}-01-30/dt={1}/run_id=0{0}.json"
    put(land, key.format(10, "2024-02-01"), {"matches": [match(1)]})
    load_matches(spark, land, lake, "matches_backfill", look_back=2)
    put(land, key.format(11, "2024-02-03"), {"matches": [match(2)]})
    m = load_matches(spark, land, lake, "matches_backfill", look_back=1, on_empty="error")
    assert (m["files_discovered"], m["files_to_load"]) == (2, 1)
    put(land, key.format(12, "2024-02-09"), {"matches": [match(3)]})
    m = load_matches(spark, land, lake, "matches_backfill", look_back=1, on_empty="error")
    assert (m["files_discovered"], m["files_to_load"]) == (2, 1)  # not the first one


def test_one_pending_file_of_many_opens_one(spark, tmp_path):
    land, _ = _lake(spark, tmp_path)
    for k in range(300):
        put(land, data_key(comp="A B+", run=f"0{k:03d}"), {"matches": [match(k)]})
    objects = L.list_objects(spark, land, "endpoint=matches/").cache()
    assert objects.count() == 300

    def of(*runs):
        return objects.where(F.col("file_key").rlike(f"run_id=0({'|'.join(runs)})\\.json"))

    for runs, files in ((["123"], 1), (["000", "299"], 2), (["010", "011", "012", "200"], 4)):
        docs = L.read_documents(spark, of(*runs), objects)
        assert docs.count() == len(runs) and opened(docs) == files
    assert opened(L.read_documents(spark, of("100", "103"))) <= 4  # without a listing: the range between them


def test_many_ranges_become_one_per_folder(spark, tmp_path, monkeypatch):
    land, _ = _lake(spark, tmp_path)
    for k in range(12):
        put(land, data_key(run=f"0{k:03d}"), {"matches": [match(k)]})
    objects = L.list_objects(spark, land, "endpoint=matches/").cache()
    wanted = objects.where(F.col("file_key").rlike("[02468]\\.json"))
    monkeypatch.setattr(L, "MAX_RANGES", 3)
    docs = L.read_documents(spark, wanted, objects)
    assert len(L.name_ranges(wanted, objects)) == 1 and docs.count() == 6 and opened(docs) <= 11


def test_counters_are_of_rows_that_were_written(spark, tmp_path):
    """A document and a manifest that do not parse are set aside, not counted as loaded."""
    land, lake = _lake(spark, tmp_path)
    for run, doc, manifest in (("0a", {"matches": [match(1)]}, {"record_count": 1}), ("0b", "{not json", None), ("0c", {"matches": []}, "[broken")):
        put(land, data_key(run=run), doc)
        if manifest is not None:
            put(land, data_key(run=run).replace(".json", ".manifest.json"), manifest)
    m = load_matches(spark, land, lake, strict=False)
    assert (m["files_discovered"], m["files_to_load"]) == (3, 3)
    assert (m["data_files_loaded"], m["manifests_loaded"], m["quarantined"]) == (2, 1, 2)
    kept = sorted((r.file_key.split("run_id=")[1], r.kind) for r in lake.quarantine.read().collect())
    assert kept == [("0b.json", "data"), ("0c.manifest.json", "manifest")]
    # in a replaced partition, too
    put(land, data_key(run="0d"), {"matches": [match(2)]})
    put(land, data_key(run="0e"), "{")
    m = load_matches(spark, land, lake, strict=False)
    assert (m["files_to_load"], m["data_files_loaded"], m["quarantined"]) == (2, 1, 1)
    with pytest.raises(Exception, match="MALFORMED|PARSE|JSON"):
        put(land, data_key(run="0f"), "{")
        load_matches(spark, land, lake)


def test_falsy_manifest_fields_fall_back_to_the_key(spark, tmp_path):
    """NULL, empty and missing fields of a landed manifest all take the value from its key."""
    land, lake = _lake(spark, tmp_path)
    fields = ({"endpoint": "", "run_id": None, "dt_partition": ""}, {}, {"endpoint": "own", "run_id": "77", "dt_partition": "2024-03-04"},
              {"endpoint": None, "run_id": "", "dt_partition": None})
    for k, own in enumerate(fields):
        put(land, data_key(run=f"0{k}"), {"matches": []})
        put(land, data_key(run=f"0{k}").replace(".json", ".manifest.json"), own | {"record_count": 0})
    load_matches(spark, land, lake)
    got = {r.file_key[-16:-14]: (r.endpoint, r.run_id, str(r.dt)) for r in lake.raw_manifests.read().collect()}
    key = lambda k: ("matches", f"0{k}", "2024-01-02")
    assert got == {"00": key(0), "01": key(1), "02": ("own", "77", "2024-03-04"), "03": key(3)}
    assert manifest_reconcile(lake.raw_matches.read(), lake.raw_manifests.read(), unmatched=True).count() == 0


def _pairs(land, n):
    for k in range(n):
        put(land, data_key(run=f"0{k:03d}"), {"matches": [match(k)]})
        put(land, data_key(run=f"0{k:03d}").replace(".json", ".manifest.json"), {"record_count": 1})


def test_documents_and_manifests_are_opened_apart(spark, tmp_path, monkeypatch):
    """They lie side by side: reading one kind leaves the files of the other closed, in every range."""
    land, lake = _lake(spark, tmp_path)
    _pairs(land, 12)
    objects = L.object_classify(L.list_objects(spark, land, "endpoint=matches/")).cache()
    manifests, data = objects.where("kind = 'manifest'"), objects.where("kind = 'data'")
    for wanted, kind in ((manifests, X.is_manifest_key), (data, X.is_data_key)):
        for listing in (None, wanted):
            docs = L.read_documents(spark, wanted, listing, kind)
            assert docs.count() == 12 and opened(docs) == 12
            assert listing is None or len(L.name_ranges(wanted, listing)) == 1
    # neither does a load
    read, scans = L.read_documents, []
    monkeypatch.setattr(L, "read_documents", lambda *how: scans.append(read(*how)) or scans[-1])
    load_matches(spark, land, lake)
    assert [opened(s) for s in scans] == [12, 12]


def test_a_load_parses_a_document_once(spark, tmp_path, monkeypatch):
    """Its rows go from the landing to the table in the job that writes them; nothing of them is kept in between."""
    land, lake = _lake(spark, tmp_path)
    _pairs(land, 4)
    kept, table = spark.sparkContext._jsc.sc().getPersistentRDDs, type(lake.raw_matches)
    before, append, seen = kept().size(), table.append, []

    def watched(self, df):
        if self.path.endswith("raw_matches"):
            seen.append((kept().size() - before, opened(df.select("file_key", "payload"))))
        return append(self, df)

    monkeypatch.setattr(table, "append", watched)
    load_matches(spark, land, lake)
    assert seen == [(2, 4)]  # the listing and its flags
    assert lake.raw_matches.read().count() == 4


def test_raw_documents_are_stored_whole(spark, tmp_path):
    """The payload is one value, not a column for each of its fields."""
    import pyarrow.parquet as pq

    land, lake = _lake(spark, tmp_path)
    _pairs(land, 2)
    load_matches(spark, land, lake)
    for path in (tmp_path / "lake" / "bronze" / "raw_matches").rglob("*.parquet"):
        fields = [f for f in pq.ParquetFile(path).schema.to_arrow_schema() if f.name == "payload"]
        assert sorted(c.name for c in fields[0].type) == ["metadata", "value"]


def test_append_new_leaves_the_callers_cache(spark, tmp_path):
    land, lake = _lake(spark, tmp_path)
    rows = raw_matches_rows(spark.createDataFrame([(data_key(), '{"matches": []}')], "file_key string, text string"), F.current_timestamp()).cache()
    assert not append_new(lake.raw_matches, rows) and rows.storageLevel.useMemory
    rows.unpersist()
    rows = rows.select("*")
    assert append_new(lake.raw_matches, rows) and not rows.storageLevel.useMemory
    assert lake.raw_matches.read().count() == 1


def test_document_and_manifest_come_from_one_grouping_and_one_read(spark, tmp_path):
    land, lake = _lake(spark, tmp_path)
    _pairs(land, 3)
    load_matches(spark, land, lake)
    pairs = landing_pairs(lake.raw_matches.read())
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert pairs.count() == 6 and plan.count("Scan parquet") == 1
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    docs = documents(snapshots(orders))
    assert docs._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    keys = [r.key for r in docs.select("key").collect()]
    data = {k for k in keys if not k.endswith(".manifest.json")}
    assert len(keys) == len({*keys}) and {k for k in keys} - data == {k.replace(".json", ".manifest.json") for k in data if "=FL1/" not in k}


def test_landing_writer_takes_documents_a_few_at_a_time(spark, tmp_path):
    """The first documents of a task are landed before its last one is made."""
    from tidewater.sources.fixture import write_objects

    body = F.when(F.col("id") < 59, F.repeat(F.lit("x"), 1 << 20)).otherwise(F.raise_error(F.lit("the last")))
    docs = spark.range(0, 60, 1, 1).select(F.format_string("endpoint=matches/%02d.json", "id").alias("key"), body.alias("body"))
    with pytest.raises(Exception, match="the last"):
        write_objects(docs, str(tmp_path))
    assert len(list((tmp_path / "endpoint=matches").glob("*.json"))) > 10
    done = write_objects(docs.where("id < 7"), str(tmp_path / "more"))
    assert done == {"objects": 7, "bytes": 7 << 20}


def test_snapshots_travel_narrow_and_tasks_follow_the_orders(spark, monkeypatch):
    from tidewater.sources import fixture

    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    monkeypatch.setattr(fixture, "TASK_MATCHES", 100)
    docs = documents(snapshots(orders))
    plan = docs._jdf.queryExecution().sparkPlan().toString()
    dealt = plan[plan.index("REPARTITION_BY_NUM"):]
    # the struct of a match is made after the one exchange
    assert docs.rdd.getNumPartitions() == orders.count() // 100 and plan.count("hashpartitioning") == 1
    assert "REGULAR_SEASON" in plan and "REGULAR_SEASON" not in dealt


def test_raw_documents_are_read_a_few_at_a_time(spark, tmp_path):
    """A row group, which a reader may take at once, is bounded by its bytes however few documents these are."""
    import hashlib

    import pyarrow.parquet as pq

    _, lake = _lake(spark, tmp_path)
    name = lambda k, i: "".join(hashlib.sha256(f"{k}-{i}-{j}".encode()).hexdigest() for j in range(64))
    for k in range(60):
        put(str(tmp_path / "texts"), data_key(run=f"0{k:02d}"), {"matches": [match(k * 100 + i, home_name=name(k, i)) for i in range(100)]})
    docs = L.read_tree(spark, str(tmp_path / "texts"), "endpoint=matches/")
    lake.raw_matches.append(raw_matches_rows(docs, F.current_timestamp()).coalesce(1))
    (path,) = (tmp_path / "lake" / "bronze" / "raw_matches").rglob("*.parquet")
    stored = pq.ParquetFile(path).metadata
    groups = [stored.row_group(k) for k in range(stored.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 60 and max(g.total_byte_size for g in groups) < 16 << 20
    assert lake.raw_matches.read().select("file_key").distinct().count() == 60


def test_backfill_builds_nothing_it_does_not_read(spark, tmp_path, monkeypatch):
    """Its chunks are landed and loaded; the lake of the daily loads is another one."""
    import shutil

    from tidewater.plans import fixture_lake
    from tidewater.plans.registry import queries

    for table in ("orders", "region"):
        shutil.copy(f"{SF_SMALL}/{table}.parquet", tmp_path)
    monkeypatch.setattr(fixture_lake, "_build", None)
    got = queries()["backfill_load"](spark, str(tmp_path)).collect()
    assert got and {r.endpoint for r in got} == {"matches_backfill"}
    assert sum(r.n_matches for r in got) == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
