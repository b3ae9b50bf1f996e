"""Every named query against its SQL twin in DuckDB."""

import duckdb
import pandas as pd
import pytest

from quarry import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(frame, columns):
    def plain(x):
        if pd.isna(x):
            return None
        return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    return sorted((tuple(plain(x) for x in r) for r in frame[columns].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_twin(spark, duck, sf_dir, name):
    got, want = plans.QUERIES[name](spark, sf_dir).toPandas(), duck.sql(plans.ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert rows(got, columns) == rows(want, columns)


def test_properties_of_incremental_dedup(spark, sf_dir):
    r = plans.QUERIES["incremental_dedup_blobs"](spark, sf_dir).toPandas()
    assert (r.new_blobs + r.dup_blobs == r.total_blobs).all()
    blobs = plans.QUERIES["blob_media_matrix_totals"](spark, sf_dir).first().blobs
    assert r.new_blobs.sum() == r.cumulative_blobs.max() <= blobs
    assert plans.QUERIES["upset_patterns"](spark, sf_dir).toPandas().n_blobs.sum() == blobs


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
