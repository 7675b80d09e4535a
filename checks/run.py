"""``python -m checks.run SF_DIR [key ...]``: compare queries with their SQL and time them."""

from __future__ import annotations

import sys
import time

from checks.compare import differences, duck
from checks.queries import oracle_sql, queries
from roadbook.session import spark_session


def main(sf_dir: str, keys: list[str]) -> int:
    spark = spark_session(
        "checks", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for key, build in queries().items():
        if keys and key not in keys:
            continue
        begin = time.perf_counter()
        try:
            got = build(spark, sf_dir).toArrow()
            spent = time.perf_counter() - begin
            begin = time.perf_counter()
            want = con.sql(sqls[key]).to_arrow_table() if key in sqls else None
            duck_spent = time.perf_counter() - begin
            issues = differences(got, want) if want is not None else []
        except Exception as error:  # report and go on with the next key
            issues, spent, duck_spent, got = [f"{type(error).__name__}: {str(error)[:600]}"], 0, 0, None
        bad += bool(issues)
        state = "DIFF" if issues else ("ok" if key in sqls else "ran")
        print(f"{state:5} {key:34} rows={got.num_rows if got is not None else '-':>7} spark={spent:6.2f}s duck={duck_spent:6.2f}s", *issues, flush=True)
    print(f"{bad} with differences")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
