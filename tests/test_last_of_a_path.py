"""Rows that share a path: the last one counts, and of predictions of one seq the first in the manifest."""

from datetime import timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.compare import SF, rows
from tracklore.operators import joins
from tracklore.plans import catalogue
from tracklore.plans.views import view


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    """Events with up to three rows of a path, in the order of their ids and the other way round."""
    made = []
    for order in ("ASC", "DESC"):
        path = tmp_path_factory.mktemp("shared")
        ids = "SELECT 100000 + event_id AS event_id, ts, user_id, event_type FROM e UNION ALL SELECT 10 * (100000 + event_id) + 2 * k + event_id % 2, ts + to_minutes(50 * k), user_id + 7 * k, event_type FROM e, range(1, 3) r(k)"
        duckdb.execute(f"COPY (WITH e AS (SELECT * FROM '{SF}/events.parquet') SELECT * FROM ({ids}) ORDER BY event_id {order}) TO '{path}/events.parquet'")
        made.append(str(path))
    return made


def ask(folder, sql):
    """Columns and rows of the SQL on one thread, where a tie goes to the row that is read first."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute("SET threads = 1")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return columns, rows(columns, result.fetchall())


def got(spark, folder, name):
    df = catalogue.QUERIES[name](spark, folder)
    return rows(df.columns, [tuple(r) for r in df.collect()])


@pytest.mark.parametrize("name", ["materialize_left_join", "upsert_last_wins"])
def test_of_one_seq_the_first_row_stays(spark, folders, name):
    assert got(spark, folders[0], name) == got(spark, folders[1], name) == ask(folders[0], catalogue.SQL[name])[1]


@pytest.mark.parametrize("name", ["stage3_inner_join", "episode_stats"])
def test_the_last_manifest_row_of_a_path_counts(spark, folders, name):
    assert got(spark, folders[0], name) == got(spark, folders[1], name) == ask(folders[0], catalogue.SQL[name])[1]


def test_a_prediction_is_joined_once(spark, folders):
    """As many rows as confident predictions, each with the greatest seq of its path."""
    p = view(spark, folders[0], "predictions").filter("confidence >= 0.5")
    m = view(spark, folders[0], "manifest").groupBy("crop_path").agg(F.max_by(F.struct("camera_id", "timestamp"), "seq").alias("m"))
    assert m.count() < view(spark, folders[0], "manifest").count()
    expected = p.join(m, "crop_path").select("crop_path", "m.camera_id", "m.timestamp", "label", "confidence")
    assert got(spark, folders[0], "stage3_inner_join") == rows(expected.columns, [tuple(r) for r in expected.collect()])


def test_each_episode_has_all_its_figures(spark, folders):
    """Episodes of the last manifest rows, made in a loop."""
    p = {}
    for r in view(spark, folders[0], "predictions").filter("confidence >= 0.5").collect():
        p.setdefault(r["crop_path"], []).append((r["label"], r["confidence"]))
    last = {r["crop_path"]: r for r in sorted(view(spark, folders[0], "manifest").collect(), key=lambda r: r["seq"])}
    series = {}
    for path, found in p.items():
        for label, confidence in found:
            series.setdefault((last[path]["camera_id"], label), []).append((last[path]["timestamp"], path, confidence, last[path]["source_path"]))
    expected = []
    for (camera, label), seen in series.items():
        made = []
        for row in sorted(seen):
            if not made or row[0] - made[-1][0][0] > timedelta(hours=6):
                made.append([])
            made[-1].append(row)
        for x in made:
            seconds, best = (x[-1][0] - x[0][0]).total_seconds(), max(r[2] for r in x)
            if seconds >= 5:
                expected.append((camera, label, x[0][0], x[-1][0], seconds, best, round(sum(r[2] for r in x) / len(x), 9), len(x), x[0][3] if "_frame_" in x[0][1] else None, best < 0.8))
    of = {s: [x for x in expected if x[1] == s] for s in {x[1] for x in expected}}
    expected = [(*x, len(of[x[1]]), sum(y[7] for y in of[x[1]]), max(y[4] for y in of[x[1]]), sum(y[9] for y in of[x[1]])) for x in expected]
    names = "camera_id species start_time end_time duration_seconds max_confidence avg_confidence frame_count source_video needs_review species_episodes species_frames species_longest species_needs_review".split()
    assert expected and got(spark, folders[0], "episode_stats") == rows(names, expected)


def test_place_is_asked_before_other_columns(spark):
    given = [("a", 1, 3, "z"), ("a", 1, 2, "x"), ("a", 0, 1, "y"), ("b", None, 1, "p"), ("b", None, 0, "q"), ("c", 1, None, "n"), ("c", 1, 5, "m")]
    df = spark.createDataFrame(given, "k string, seq int, at int, v string")
    found = joins.last_wins(df, "k", "seq", "at")
    assert found.columns == ["k", "seq", "v"]
    assert {r["k"]: r["v"] for r in found.collect()} == {"a": "x", "b": "q", "c": "m"}
