"""Time the headline queries and print one JSON line.

`BENCH_SF_DIR` names the test folder, `BENCH_CPUS` the local cores. Each query
is written to the `noop` sink; the time is the median of `BENCH_RUNS` runs.
`inputs` is the first query of the session, which derives and writes the input
tables. `scaling` repeats both reports over 13, 52 and 104
snapshots, where a run per snapshot would grow in proportion.
"""

from __future__ import annotations

import json
import os
import time
from datetime import timedelta
from statistics import median

from pyspark.sql import DataFrame

from loanbook.params import Calendar
from loanbook.plans.catalog import QUERIES, cover_book, credit_book
from loanbook.session import build_session
from loanbook.sources.fixtures import CALENDAR

HEADLINE = [
    "ledger_normalize",
    "running_balance",
    "next_withdrawal",
    "withdrawal_repayments",
    "asof_expand",
    "cb_states",
    "cb_report",
    "cb_roll",
    "cover_states",
    "cover_report",
    "dpd_bucket",
    "status_counts",
]


def seconds(build, runs: int) -> float:
    def once() -> float:
        start = time.perf_counter()
        frame: DataFrame = build()
        frame.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    return round(median(once() for _ in range(runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "loanbook-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first query derives and writes the input tables; later ones read them.
    times = {"inputs": seconds(lambda: QUERIES["account_map"](spark, sf_dir), 1)}
    times |= {name: seconds(lambda n=name: QUERIES[n](spark, sf_dir), runs) for name in HEADLINE}
    scaling = {}
    for count in (13, 52, 104):
        span = Calendar(CALENDAR.end - timedelta(weeks=count - 1), CALENDAR.end)
        scaling[f"cover_{count}"] = seconds(lambda: cover_book(spark, sf_dir, span).report(), runs)
        scaling[f"credit_{count}"] = seconds(lambda: credit_book(spark, sf_dir, span).roll(), runs)
    result = {
        "metric": "total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "scaling": scaling,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
