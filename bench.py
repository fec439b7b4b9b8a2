"""Time every query of the catalog; prints one JSON line.

BENCH_SF_DIR: the tables (default /root/testdata/sf0.1). BENCH_CPUS: local cores
(default 8). BENCH_RUNS: timed runs per query, the best counts (default 2, after
one untimed run; one, for queries of over ENOUGH seconds). BENCH_SCRATCH: the folder of stored intermediate tables
(default a new temporary folder, as this session is local).
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from postline.plans.catalog import QUERIES
from postline.session import build_session


ENOUGH = 10


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
        spark__checkpoint__dir=os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        times = [run(name)]
        while len(times) < runs and times[0] < ENOUGH:
            times.append(run(name))
        seconds[name] = round(min(times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "seconds for all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
