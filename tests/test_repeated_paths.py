"""Paths that several rows share, as the manifest has them from a million events on: its file names keep six digits."""

import duckdb
import pytest

from tests.compare import SF, rows
from tracklore.operators import joins
from tracklore.plans import catalogue
from tracklore.plans.views import with_views

EPISODES = "compress_observations compress_observations_6h compression_ratio episode_stats episode_timeline sink_compressed_json stage3_report_camera stage3_report_species stage3_report_totals stage3_download_summary stream_compress".split()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Events 100000 to 100999 of seven users, and again each with a digit more: two or three share a path."""
    path = tmp_path_factory.mktemp("repeated")
    ids = "SELECT 100000 + event_id AS event_id, ts, user_id, event_type FROM e UNION ALL SELECT 10 * (100000 + event_id) + 2 * k + event_id % 2, ts + to_minutes(50 * k), user_id + 7 * k, event_type FROM e, range(1, 3) r(k)"
    duckdb.execute(f"COPY (WITH e AS (SELECT * FROM '{SF}/events.parquet') {ids}) TO '{path}/events.parquet'")
    return str(path)


@pytest.mark.parametrize("name", ["stage3_inner_join", *EPISODES])
def test_every_row_of_a_path_is_joined(spark, folder, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    assert con.execute(with_views("manifest", "SELECT count(*) > count(DISTINCT crop_path) FROM manifest")).fetchone()[0]
    result = con.execute(catalogue.SQL[name])
    columns = [c[0] for c in result.description]
    df = catalogue.QUERIES[name](spark, folder)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, result.fetchall())


def test_the_last_of_a_path_is_joined_on_request(spark):
    m = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "crop_path string, seq int, timestamp string")
    p = spark.createDataFrame([("a", 0.9), ("a", 0.4), ("b", 0.9)], "crop_path string, confidence double")
    assert sorted(r["timestamp"] for r in joins.stage3_inner_join(m, p).collect()) == ["x", "y"]
    assert [r["timestamp"] for r in joins.stage3_inner_join(m, p, seq="seq").collect()] == ["y"]


def test_rows_of_one_seq_have_one_winner_in_any_order(spark):
    given = [("a", 1, x) for x in "badc"] + [("b", None, "x"), ("b", 0, "a"), ("c", None, "y")]
    for rows_ in (given, given[::-1]):
        df = spark.createDataFrame(rows_, "k string, seq int, v string").coalesce(1)
        assert {r["k"]: r["v"] for r in joins.last_wins(df, "k", "seq").collect()} == {"a": "d", "b": "a", "c": "y"}
