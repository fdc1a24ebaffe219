"""Run registered queries against their SQL twins and report differences.

    python tools/compare.py [sf or folder] [name ...]
"""

import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, ".")
from lanternstats.fixtures import TABLES  # noqa: E402
from lanternstats.oracles import ORACLES  # noqa: E402
from lanternstats.queries import QUERIES  # noqa: E402
from lanternstats.session import build_session  # noqa: E402


def normal(frame):
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        kind = str(frame[c].dtype)
        if kind.startswith("datetime"):
            frame[c] = frame[c].astype("datetime64[us]").astype(str)
        elif kind.startswith("float") or kind in ("Int64", "int64", "int32", "Int32"):
            frame[c] = pd.to_numeric(frame[c]).astype(float).round(6).astype(str)
        else:
            frame[c] = frame[c].map(lambda v: "None" if pd.isna(v) else str(v))
    frame = frame.map(lambda v: "None" if v in ("nan", "NaT", "None", "<NA>") else v)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    folder = sf if sf.startswith("/") else f"/root/testdata/sf{sf}"
    spark = build_session(
        "local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name in names:
        start = time.time()
        try:
            result = QUERIES[name](spark, folder)
            types = {f.name: f.dataType.simpleString() for f in result.schema.fields}
            got = result.toPandas()
        except Exception as e:
            bad += 1
            print(f"FAIL  {name}: {str(e)[:600]}")
            continue
        took = time.time() - start
        if name not in ORACLES:
            print(f"rows  {name}: {len(got)} ({took:.1f}s)")
            continue
        try:
            relation = con.sql(ORACLES[name])
            duck_types = dict(zip(relation.columns, map(str, relation.types)))
            want = relation.df()
        except Exception as e:
            bad += 1
            print(f"SQL   {name}: {str(e)[:600]}")
            continue
        same = {
            "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
            "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE",
        }
        off = {c: (types[c], duck_types.get(c)) for c in types if same.get(types[c]) != duck_types.get(c)}
        if sorted(got.columns) != sorted(want.columns):
            bad += 1
            print(f"COLS  {name}: {sorted(got.columns)} {sorted(want.columns)}")
            continue
        a, b = normal(got), normal(want)
        if a.equals(b):
            print(f"ok    {name}: {len(a)} rows {took:.1f}s" + (f"  TYPES {off}" if off else ""))
        else:
            bad += 1
            print(f"DIFF  {name}: {len(a)} vs {len(b)}")
            both = a.merge(b, how="outer", indicator=True)
            print(both[both["_merge"] != "both"].head(6).to_string())
    print("bad:", bad)


main()
