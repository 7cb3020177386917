"""Driver contract: entry runs; each oracle matches its query at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF0001
from tools.check_oracle import TABLES, digest


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["split", "event_type", "n", "mean_value", "mean_log_value"]
    assert df.count() == 10


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


FAST = ["flagship", "p2_missing_per_column", "c1_impute_median", "c3_sequential_outliers",
        "c5_first_per_text", "f7_bins", "e1_anova_f", "x1_stratified_holdout",
        "x2_stratified_kfold", "m8_soft_vote", "i1_score", "v3_classification_report"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_oracle_matches(spark, con, name):
    sdf = E.queries()[name](spark, SF0001)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    srows = [tuple(r) for r in sdf.collect()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows) == digest(dcols, drows)
