"""Test helpers: write hand-made landing objects, compare result sets."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import math
import os

import duckdb

SF_SMALL = "/root/testdata/sf0.001"

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def put(root: str, key: str, payload) -> str:
    path = os.path.join(root, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload))
    return path


def data_key(comp="PL", day="2024-01-02", run="0a-1", endpoint="matches"):
    d = dt.date.fromisoformat(day)
    return (f"endpoint={endpoint}/competition={comp}/dateFrom={(d - dt.timedelta(days=1)).isoformat()}/"
            f"dateTo={(d + dt.timedelta(days=7)).isoformat()}/dt={day}/run_id={run}.json")


def match(mid, utc="2024-01-01T12:00:00Z", status="FINISHED", home=1, away=2, hg=1, ag=0, winner="HOME_TEAM",
          comp="PL", season=11, last_updated="2024-01-01T00:00:00Z", home_name=None, away_name=None):
    m = {
        "id": mid, "utcDate": utc, "status": status, "stage": "REGULAR_SEASON", "matchday": 1,
        "lastUpdated": last_updated,
        "competition": {"id": 2021, "code": comp, "name": "League", "type": "LEAGUE"},
        "season": {"id": season, "startDate": "2024-01-01", "endDate": "2024-12-31", "currentMatchday": 1},
        "homeTeam": None if home is None else {"id": home, "name": home_name or f"Team {home}", "shortName": f"T{home}"},
        "awayTeam": None if away is None else {"id": away, "name": away_name or f"Team {away}", "shortName": f"T{away}"},
        "score": {"winner": winner, "duration": "REGULAR", "fullTime": {"home": hg, "away": ag},
                  "halfTime": {"home": None if hg is None else hg // 2, "away": None if ag is None else ag // 2}},
    }
    if utc is None:
        del m["utcDate"]
    return m


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def result_digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def assert_equal_to_full_recompute(lake):
    """Every derived table equals its model over all raw rows, and the test state equals the whole suite."""
    from tidewater.plans import gold, silver
    from tidewater.plans.runs import suite_report

    latest = silver.matches_latest(silver.flatten_matches(lake.raw_matches.read(), keep_pos=True)).cache()
    want = {"matches_latest": latest, "teams": silver.teams(latest).drop("updated_at"),
            "team_form_last5": gold.team_form(latest, 5), "league_table_snapshot": gold.league_table(latest)}
    for name, df in want.items():
        key = lambda r: tuple((x is None, str(x)) for x in r)
        got = sorted(map(tuple, getattr(lake, name).read().select(df.columns).collect()), key=key)
        assert got == sorted(map(tuple, df.collect()), key=key), name
    latest.unpersist()
    assert sorted(suite_report(lake).collect()) == sorted(suite_report(lake, full=True).collect())
