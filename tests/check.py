"""Run queries against their SQL: ``python tests/check.py [name-prefix ...]``."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle import connect, difference  # noqa: E402
from tidemark.plans.catalog_of_queries import ORACLE, QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main(prefixes):
    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in QUERIES:
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        began = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLE:
                verdict = difference(df, con, ORACLE[name])
                shown = "ok" if verdict is None else f"DIFF {verdict}"
            else:
                shown, verdict = f"rows {df.count()} (no SQL)", None
        except Exception as e:
            verdict, shown = str(e), "ERROR " + "".join(traceback.format_exception_only(e))[:1500]
        bad += verdict is not None
        print(f"{name:32s} {time.time() - began:6.2f}s {shown}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
