"""Print the formatted physical plan of registered plans.

    python -m tools.explain [--sf DIR] [--no-broadcast] key [key ...]

``--no-broadcast`` disables automatic broadcasts, which shows the plan shape a
large input would get (sort-merge joins, all exchanges).
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--no-broadcast", action="store_true")
    ap.add_argument("keys", nargs="+")
    a = ap.parse_args(argv)
    sys.path.insert(0, ".")
    from quarry.plans import PLANS
    from quarry.session import get_session
    spark = get_session("local[8]", 8)
    if a.no_broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for k in a.keys:
        print(f"===== {k}: {PLANS[k].doc.splitlines()[0] if PLANS[k].doc else ''}")
        PLANS[k].fn(spark, a.sf).explain("formatted")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
