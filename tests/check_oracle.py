"""Compare registered queries with their SQL: ``check_oracle.py SF_DIR [name ...]``.

With ``--files`` as a name, results are compared through Parquet files in the scratch
folder instead of in memory, which suits larger data.
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract
from tests.support import compare, compare_files, make_session, oracle

if __name__ == "__main__":
    sf_dir, *names = sys.argv[1:]
    through_files = "--files" in names
    names = [name for name in names if name != "--files"]
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = make_session(scratch)
    db, sql = oracle(sf_dir), contract.oracle_sql()
    failed = 0
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            frame = run(spark, sf_dir)
            if name in sql and through_files:
                verdict = compare_files(frame, db, sql[name], f"{scratch}/{name}") or "ok"
            elif name in sql:
                verdict = compare(frame, db, sql[name]) or "ok"
            else:
                verdict = f"ok, {frame.count()} rows, no SQL"
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not verdict.startswith("ok")
        print(f"{name:24s} {time.time() - began:6.2f}s  {verdict}", flush=True)
    print("failed:", failed)
