"""Relational queries that do their whole job."""

import duckdb
import pytest
from pyspark.sql import functions as F

from sitegraph.plans import publishing, relational


def test_domain_candidates_pair_companies_with_hosts(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "https://www.muster-bau.de/"), (2, "https://musik.de/"), (3, "http://abcolor.de/x"), (4, "http://muster.com/")], "page_id long, url string")
    firms = spark.createDataFrame([(1, "Muster Bau GmbH"), (2, "AB Color"), (3, "Mu"), (4, None)], "doc_id long, name string")
    monkeypatch.setattr(relational, "table", lambda *a: pages)
    monkeypatch.setattr(relational, "companies", lambda *a: firms)
    got = {tuple(r) for r in relational.domain_candidates(spark, "").select("doc_id", F.col("host")).collect()}
    assert got == {(1, "muster-bau.de"), (1, "muster.com"), (2, "abcolor.de")}


@pytest.mark.parametrize("module, name", [(relational, "state_boxes"), (publishing, "ui_boxes")])
def test_boxes_round_half_a_millionth_like_their_sql(spark, monkeypatch, module, name):
    """53.2362 + 0.005 * 0.6719 is 53.2395595; one rounding more makes 53.23955949999999."""
    rows = [("Bremen", 8.0, 53.2362), ("Bremen", 8.0, 53.908100000000005), ("Berlin", 8.5, 53.0296), (None, 8.25, 53.5), ("Hessen", None, None)]
    rows += [("Bayern", 8.0 + i / 1000, 53.0 + i * 0.0007) for i in range(33)]
    firms = spark.createDataFrame(rows, "state string, longitude double, latitude double")
    monkeypatch.setattr(module, "companies", lambda *a: firms)
    sql = module.ORACLE_SQL[name].replace(module.COMPANIES_SQL, "co AS (SELECT * FROM firms)")
    if name == "ui_boxes":
        sql = "WITH r AS (SELECT * FROM firms), " + sql[sql.index("b AS (SELECT state") :]
    con = duckdb.connect()
    con.execute("CREATE TABLE firms (state VARCHAR, longitude DOUBLE, latitude DOUBLE)")
    con.executemany("INSERT INTO firms VALUES (?, ?, ?)", rows)
    if name == "state_boxes":
        con.execute("ALTER TABLE firms ADD COLUMN source VARCHAR")
    want = con.sql(sql)
    got = getattr(module, name)(spark, "").select(want.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))
    assert {r["state"]: r["south"] for r in got}["Bremen"] == 53239560
