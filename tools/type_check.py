"""List plans whose Spark result types differ from the DuckDB result types.

    python -m tools.type_check [--sf DIR]
"""

from __future__ import annotations

import argparse
import sys

SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "binary": "BLOB", "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def duck_type(spark_type) -> str:
    s = spark_type.simpleString()
    if s.startswith("array<"):
        return duck_type(spark_type.elementType) + "[]"
    if s.startswith("decimal"):
        return s.upper().replace("DECIMAL", "DECIMAL")
    return SPARK_TO_DUCK.get(s, s)


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args(argv)
    sys.path.insert(0, ".")
    from quarry.plans import PLANS
    from quarry.session import get_session
    from tools.oracle_check import duck_connect
    spark = get_session("local[8]", 8)
    con = duck_connect(a.sf)
    n = 0
    for k in a.keys or sorted(PLANS):
        p = PLANS[k]
        if p.sql is None:
            continue
        df = p.fn(spark, a.sf)
        rel = con.sql(p.sql)
        s = {f.name: duck_type(f.dataType) for f in df.schema.fields}
        d = dict(zip(rel.columns, [str(t) for t in rel.types]))
        diff = {c: (s.get(c), d.get(c)) for c in sorted(set(s) | set(d)) if s.get(c) != d.get(c)}
        if diff:
            n += 1
            print(k, diff)
    print(n, "plans with type differences")


if __name__ == "__main__":
    raise SystemExit(main())
