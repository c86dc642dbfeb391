"""Regenerate vatlens/sql/decimal_cols.py: for every SQL twin, the output
columns DuckDB types as DECIMAL. The twins' outputs are wrapped so those
columns are DOUBLE, like the Spark queries' outputs (money is DECIMAL inside
both engines, DOUBLE at the report boundary).

usage: python tools/gen_decimal_cols.py [sf_dir]
"""

import os
import pprint
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from vatlens.sources.tables import TESTDATA_TABLES  # noqa: E402
from vatlens.sql.oracle import ORACLE  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
con = duckdb.connect()
for t in TESTDATA_TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
out = {}
for k, q in ORACLE.items():
    rel = con.sql(q)
    cols = [c for c, t in zip(rel.columns, rel.types) if str(t).startswith("DECIMAL")]
    if cols:
        out[k] = cols
path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "vatlens", "sql", "decimal_cols.py")
with open(path, "w") as f:
    f.write('"""Generated by tools/gen_decimal_cols.py: DECIMAL output columns of each SQL twin."""\n\n')
    f.write("DECIMAL_COLS = " + pprint.pformat(out, width=110) + "\n")
print(len(out), "keys with decimal outputs")
