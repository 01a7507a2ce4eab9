"""Run contract queries against their DuckDB oracle.

usage: python tools/check_contract.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vigil.plans import registry  # noqa: E402
from vigil.plans.compare import compare, duck_connect  # noqa: E402
from vigil.session import local_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    con = duck_connect(sf_dir)
    reg = registry.all_queries()
    bad = 0
    for name, (fn, sql) in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            r = compare(spark, con, name, fn, sql, sf_dir)
        except Exception as e:  # report and continue
            r = {"query": name, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        r["sec"] = round(time.time() - t0, 2)
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(json.dumps(r, default=str), flush=True)
    print(json.dumps({"total": len(names) or len(reg), "not_ok": bad}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
