"""Timings of the headline queries and of saving and loading ticks.

Reads ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]`` and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from tickloom import session
from tickloom.operators.quality import FAILED
from tickloom.plans.queries import QUERIES
from tickloom.schema import RAW_TICK
from tickloom.sources import raw, shared_tables as tables, stores

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
RAW_BYTES = 56_000_000
NAMES = os.environ.get("BENCH_QUERIES", "").split() or list(QUERIES)


def best(run) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 4)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def megabytes(folder: str) -> float:
    files = [os.path.join(at, f) for at, _, names in os.walk(folder) for f in names]
    return round(sum(os.path.getsize(f) for f in files if not f.endswith(".crc")) / 1e6, 1)


def storage(spark, folder: str) -> tuple[dict[str, float], dict[str, float]]:
    """Scan, save and load of one raw tick file about as large as the file of the
    storage baseline: the ticks of the table, repeated until they fill it."""
    spt, store = f"{folder}/raw", f"{folder}/ticks"
    ticks = tables.ticks(spark, SF_DIR)
    columns = [
        F.date_format("UpdateTime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("UpdateTime")
        if name == "UpdateTime"
        else (F.col(name) if name in ticks.columns else F.lit(None).cast("string")).alias(name)
        for name in RAW_TICK.names
    ]
    copies = max(1, round(RAW_BYTES / 140 / max(1, ticks.count())))
    repeated = ticks.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    repeated.select(*columns).write.mode("overwrite").csv(f"{spt}/2024/4/AG/AG2401/2024/202401/20240101.spt")

    def scan():
        return raw.with_file_columns(raw.scan(spark, spt, "*/*/*/*/*/*/*.spt/*.csv").drop(FAILED))

    seconds = {"scan_raw_file": best(lambda: consume(scan()))}
    # The file is a folder of parts, so its path says less than a raw file's does.
    scanned = scan().withColumns({"month": F.lit("202401"), "market": F.lit(4)}).persist()
    rows = scanned.count()
    seconds["save_ticks"] = best(lambda: stores.write_ticks(scanned, store))
    seconds["load_ticks_store"] = best(lambda: consume(stores.read_ticks(spark, store, scanned.schema)))
    scanned.unpersist()
    return seconds, {"rows": rows, "raw_mb": megabytes(spt), "store_mb": megabytes(store)}


def main() -> None:
    spark = session.build(
        f"local[{CPUS}]",
        "tickloom-bench",
        spark__sql__shuffle__partitions=CPUS,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2m",
        spark__driver__memory="20g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    consume(QUERIES["kline_1h"](spark, SF_DIR))
    seconds = {name: best(lambda name=name: consume(QUERIES[name](spark, SF_DIR))) for name in NAMES}
    with tempfile.TemporaryDirectory(prefix="tickloom-bench-") as folder:
        stored_seconds, sizes = storage(spark, folder)
        seconds |= stored_seconds
    print(
        json.dumps(
            {
                "metric": "tick_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "storage": sizes,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
