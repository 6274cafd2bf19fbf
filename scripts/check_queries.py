"""Run registered queries against their DuckDB oracles: python scripts/check_queries.py [sf_dir] [names...]."""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bandwise.plans import registry  # noqa: E402
from bandwise.session import local_session  # noqa: E402
from tests.harness import compare, duck  # noqa: E402


def main() -> int:
    import tests.harness as h

    h.STRICT = os.environ.get("STRICT", "1") == "1"
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.REGISTRY)
    spark = local_session(tempfile.mkdtemp(prefix="bandwise-"), 8)
    if os.environ.get("ANSI") is not None:  # check both cast semantics
        spark.conf.set("spark.sql.ansi.enabled", "true" if os.environ["ANSI"] == "1" else "false")
    if os.environ.get("SESSION_TZ"):  # results must not depend on the session time zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    con = duck(sf_dir)
    bad = 0
    for name in names:
        q = registry.REGISTRY[name]
        t0 = time.time()
        try:
            df = q.run(spark, sf_dir)
            if q.sql is None:
                res = {"rows": (df.count(), None), "columns_ok": True, "values_ok": True}
            else:
                res = compare(df, con, q.sql)
        except Exception as e:  # report and go on
            res = {"error": repr(e)[:600]}
        ok = res.get("values_ok") and res.get("columns_ok") and res.get("types_ok", True) and res["rows"][0] == (res["rows"][1] or res["rows"][0])
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t0:6.1f}s {res}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
