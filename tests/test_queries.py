"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tsline import suite
from tsline.functions.timeunit import PRECISION_NS

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in suite.QUERIES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in suite.QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return round(v, 6) if isinstance(v, float) else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["line"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert _rows(got) == _rows(want)


def test_time_to_ns_of_any_id(spark, tmp_dir):
    """A row whose value has no bigint of ns in one unit keeps its other values, and all rows stay."""
    most = (1 << 63) - 1
    ids = [0, 1, -1, 2_562_047, 2_562_048, -2_562_047, -2_562_048, 9_223_372_036, 9_223_372_037, most, -most - 1, None]
    spark.createDataFrame([(i,) for i in ids], "event_id long").write.parquet(f"{tmp_dir}/events.parquet")
    out = QUERIES["time_to_ns"](spark, tmp_dir)
    want = {i: {p: None if i is None or not -most - 1 <= i * f <= most else i * f for p, f in PRECISION_NS.items()}
            for i in ids}
    rows = out.collect()
    assert len(rows) == len(ids)
    assert {r["event_id"]: {p: r[f"ns_from_{p}"] for p in PRECISION_NS} for r in rows} == want
    assert {t for _, t in out.dtypes} == {"bigint"}
