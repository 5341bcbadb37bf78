"""Run every registered query beside its SQL: python tests/check_all.py SF_DIR [name ...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tests.compare import assert_same, duck  # noqa: E402
from tideline import build_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("OFF")
    con, oracles, failures = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                assert_same(df, con, oracles[name])
            print(f"ok   {name} {time.time() - began:.1f}s", flush=True)
        except Exception as e:
            failures += 1
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:600]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
