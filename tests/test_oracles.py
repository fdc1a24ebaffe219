"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from lanternstats.fixtures import TABLES
from lanternstats.oracles import ORACLES
from lanternstats.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def plain(frame):
    """Rows as sorted text, columns in name order."""
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        kind = str(frame[c].dtype)
        if kind.startswith("datetime"):
            frame[c] = frame[c].astype("datetime64[us]").astype(str)
        elif kind.lower().startswith(("float", "int")):
            frame[c] = pd.to_numeric(frame[c]).astype(float).round(6).astype(str)
        else:
            frame[c] = frame[c].map(lambda v: "None" if pd.isna(v) else str(v))
    frame = frame.map(lambda v: "None" if v in ("nan", "NaT", "None", "<NA>") else v)
    return sorted(map(tuple, frame.to_numpy()))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    relation = duck.sql(ORACLES[name])
    types = {f.name: SAME_TYPE.get(f.dataType.simpleString()) for f in result.schema.fields}
    assert types == dict(zip(relation.columns, map(str, relation.types)))
    assert plain(result.toPandas()) == plain(relation.df())
