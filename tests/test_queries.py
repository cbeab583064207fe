"""Every named market query against its SQL on the smallest tables."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalog, feeds, live
from tidemark.sources import parse

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str(v)


def test_every_query_has_sql():
    assert catalog.queries().keys() == catalog.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(spark, tables, name):
    found = catalog.queries()[name](spark, SF)
    columns = sorted(found.columns)
    answer = tables.execute(catalog.oracle_sql()[name])
    theirs = [d[0] for d in answer.description]
    assert sorted(theirs) == columns
    want = sorted(tuple(plain(r[theirs.index(c)]) for c in columns) for r in answer.fetchall())
    assert sorted(tuple(map(plain, r)) for r in found.select(*[f"`{c}`" for c in columns]).collect()) == want


@pytest.mark.parametrize("name", ["oi_change", "spread_state", "spread_state_plain"])
def test_rows_of_one_time_come_in_order_of_their_ids(spark, tmp_path, name):
    """Six copies of every event at its own time, dealt out at random; with one thread DuckDB keeps the table's order."""
    db = duckdb.connect(config={"threads": 1})
    db.execute(f"""CREATE TABLE events AS SELECT event_id * 6 + k AS event_id, ts, user_id, event_type, value + k * 7 % 5 AS value, props
      FROM (SELECT * FROM '{SF}/events.parquet' WHERE event_id < 300), range(6) r(k) ORDER BY event_id, k""")
    db.execute(f"COPY (SELECT * FROM events ORDER BY hash(event_id)) TO '{tmp_path}/events.parquet'")
    found = catalog.queries()[name](spark, str(tmp_path))
    answer = db.execute(catalog.oracle_sql()[name])
    theirs = [d[0] for d in answer.description]
    want = sorted(tuple(plain(r[theirs.index(c)]) for c in found.columns) for r in answer.fetchall())
    assert sorted(tuple(map(plain, r)) for r in found.collect()) == want


def test_a_deviation_below_that_of_the_sql_counts_as_none(spark, tmp_path):
    """Values of a symbol that differ by less than 1e-9, then by more."""
    db = duckdb.connect(config={"threads": 1})
    db.execute("CREATE TABLE events AS SELECT k AS event_id, TIMESTAMP '2024-01-01' + k * INTERVAL 1 SECOND AS ts, 1 AS user_id, 'a' AS event_type, 29.27 + CASE WHEN k < 6 THEN k * 1e-12 ELSE k END AS value, '{}' AS props FROM range(9) r(k)")
    db.execute(f"COPY events TO '{tmp_path}/events.parquet'")
    found = catalog.queries()["spread_state_plain"](spark, str(tmp_path)).orderBy("timestamp").collect()
    want = db.execute(f"SELECT * FROM ({catalog.oracle_sql()['spread_state_plain']}) ORDER BY timestamp").fetchall()
    assert [tuple(map(plain, r)) for r in found] == [tuple(map(plain, r)) for r in want]
    assert [r.z4 for r in found][:6] == [0] * 6 and found[6].z4 > 0


@pytest.mark.parametrize("name", ["guard_stream", "recover_gaps_stream", "ohlcv_timed_stream", "throttle_stream"])
def test_streams_take_bounded_shares(spark, tables, monkeypatch, name):
    """Runs of few rows each, as many as the input needs, give what one run gives."""
    monkeypatch.setattr(live, "SHARE_ROWS", 300)
    sizes, whole = [], live.in_runs

    def watched(spark, rows, order, base, start, *others):
        def counted(stream, *bounds):
            query = start(stream, *bounds)
            query.awaitTermination()
            sizes.append(sum(p.numInputRows for p in query.recentProgress))
            return query

        return whole(spark, rows, order, base, counted, *others)

    monkeypatch.setattr(live, "in_runs", watched)
    test_query_equals_its_sql(spark, tables, name)
    assert len(sizes) >= 3 and max(sizes) <= 320


def test_shares_are_even_and_keep_equal_values_together(spark, monkeypatch):
    monkeypatch.setattr(live, "SHARE_ROWS", 50)
    rows = spark.range(400).select(F.when(F.col("id") < 300, F.col("id")).otherwise(F.lit(3 * 10**9)).alias("at"))
    edges = live._edges(rows, "at", 2)
    assert edges == sorted(set(edges)) and edges[-1] <= 3 * 10**9
    assert live._edges(rows.where("at < 300"), "at", 2)[::2] and max(b - a for a, b in zip([0, *live._edges(rows.where("at < 300"), "at", 2)], [*live._edges(rows.where("at < 300"), "at", 2), 300], strict=True)) <= 50
    assert live._edges(rows.where("false"), "at", 2) == [] and live._edges(rows.where("at >= 300"), "at", 2) == []


def test_a_payload_is_read_once(spark):
    """A filter on the fields does not read the text again."""
    found = catalog.queries()["parse_liquidations"](spark, SF)
    assert found._jdf.queryExecution().executedPlan().toString().count("from_json(") == 2  # the object and the order within it


def test_answers_stay_short_with_more_parts(spark, tables, tmp_path, monkeypatch):
    spark.read.parquet(f"{SF}/part.parquet").withColumn("p_brand", F.lit("B")).withColumn("p_size", F.lit(7)).withColumn("p_retailprice", F.lit(1000.0)).write.parquet(f"{tmp_path}/part.parquet")
    seen, plain_parser = [], parse.exchange_metadata
    monkeypatch.setattr(feeds, "ANSWER_KEYS", 10)
    monkeypatch.setattr(parse, "exchange_metadata", lambda df, configured: (seen.append(df), plain_parser(df, configured))[1])
    rows = catalog.queries()["exchange_metadata"](spark, str(tmp_path)).count()
    assert rows == spark.read.parquet(f"{SF}/part.parquet").count() > 10
    assert seen[0].select(F.max(F.size(F.split("data", "PRICE_FILTER")) - 1)).first()[0] <= 10
