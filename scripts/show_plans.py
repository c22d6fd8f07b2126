"""Print the executed physical plans of selected registered queries.

    python scripts/show_plans.py [sf_dir] [query ...]

Each query is run once through the ``noop`` sink first, so the adaptive plan
shown is the final one AQE chose.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT = ["cdc_apply_latest", "cdc_apply", "mart_reservation_information", "select_columns"]


def main() -> None:
    from lakeshift.queries.registry import QUERIES
    from lakeshift.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = args or DEFAULT
    spark = local_session(8)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        print(f"===== {name}")
        print(df._jdf.queryExecution().executedPlan().toString())


if __name__ == "__main__":
    main()
