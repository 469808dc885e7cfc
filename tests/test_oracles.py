"""Every query of the engine against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from gridloom.plans.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def order(v):
    """Sort key that is alike for values of both engines: floats to 12 digits only, others whole."""
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    return (1, f"{v + 0.0:+.11e}") if isinstance(v, float) else (1, repr(v))


def same(a, b):
    """Equal type and value; floats within 1e-9 of each other, as sums depend on their order."""
    if a is None or b is None:
        return a is b
    if type(a) is not type(b):
        return False
    return a == b or (isinstance(a, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, db, name):
    got = QUERIES[name](spark, SF)
    cur = db.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    assert sorted(got.columns) == sorted(names)
    columns = sorted(names)
    exact = lambda row: [order(v) for v in row if not isinstance(v, float)] + [order(round(v, 5)) for v in row if isinstance(v, float)]
    ours = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=exact)
    theirs = sorted((tuple(r[names.index(c)] for c in columns) for r in want), key=exact)
    assert len(ours) == len(theirs)
    wrong = [(a, b) for a, b in zip(ours, theirs, strict=True) if not all(map(same, a, b))]
    assert not wrong, wrong[:3]


def test_household_at_the_limit_matches_sql(spark, tmp_path):
    """Households of 7 imputed of 25 readings (28 %, the limit) and of 8 of 26."""
    path = f"{tmp_path}/events.parquet"
    con = duckdb.connect()
    con.execute(f"COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * i AS ts, CASE WHEN i < 100 THEN 1 ELSE 6 END::BIGINT AS user_id, 'view' AS event_type, 1.0 + i % 3 AS value FROM range(4, 128) t(i) WHERE i < 29 OR i > 101) TO '{path}' (FORMAT parquet)").fetchall()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path}')").fetchall()
    want = con.execute(ORACLES["imputed_over_limit"]).fetchall()
    assert want == [(1, 6)]
    assert [(r.project, r.house) for r in QUERIES["imputed_over_limit"](spark, str(tmp_path)).collect()] == want
