"""Every registered query against its SQL oracle (DuckDB) on sf0.001."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from cascata.plans import catalog
from cascata.sources.tables import TABLES

BASE = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def _digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{BASE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracles())
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "word_count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, BASE)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_rendering_does_not_depend_on_session_zone(spark, con):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = E.queries()["delimited_record"](spark, BASE)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = con.execute(E.oracle_sql()["delimited_record"])
    assert _digest(df.columns, rows) == _digest([d[0] for d in res.description], res.fetchall())


def test_results_do_not_depend_on_ansi_mode(spark, con):
    old = spark.conf.get("spark.sql.ansi.enabled")
    names = ["word_count", "document_lines", "decode_bytes", "delimited_record", "running_sum_by_key",
             "snapshot_per_event", "request_dead_letter"]
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        got = {n: (E.queries()[n](spark, BASE)) for n in names}
        got = {n: (df.columns, [tuple(r) for r in df.collect()]) for n, df in got.items()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    for n, (cols, rows) in got.items():
        res = con.execute(E.oracle_sql()[n])
        assert _digest(cols, rows) == _digest([d[0] for d in res.description], res.fetchall()), n
