"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vigilseries import get_session  # noqa: E402
from vigilseries.operators.missing import impute_linear  # noqa: E402
from vigilseries.operators.windows import build_features, rolling_mean_std, rolling_mean_std_valid, rolling_stats  # noqa: E402
from vigilseries.plans import tables  # noqa: E402
from vigilseries.plans.catalog import QUERIES  # noqa: E402
from vigilseries.session import materialize  # noqa: E402
from vigilseries.sources.files import METRICS  # noqa: E402

WHOLE = ("impute_linear", "rolling_mean_std", "rolling_mean_std_valid", "rolling_stats", "build_features", "seasonal_decompose",
         "histogram", "kde", "optimise_threshold", "overlay_episodes", "similar_logs", "knn_classify", "isolation_forest")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", spark__master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                        spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    # Each query runs twice: the first run also compiles code, the second is the time reported.
    cold = {name: timed(lambda name=name: run(QUERIES[name](spark, sf))) for name in WHOLE}
    queries = {name: timed(lambda name=name: run(QUERIES[name](spark, sf))) for name in WHOLE}

    # Operators alone, on an indexed table: 1 and 4 copies of the data, laid end to end.
    base = tables.clean(spark, sf)
    table = {1: materialize(base)}
    n = table[1].count()
    copies = spark.range(4).withColumnRenamed("id", "copy")
    longer = table[1].join(copies).selectExpr(
        *[f"`{c}` + copy * {n} AS `{c}`" if c == "row_idx" else f"`{c}`" for c in table[1].columns])
    table[4] = materialize(longer.withMetadata("row_idx", table[1].schema["row_idx"].metadata))
    raw = materialize(tables.indexed(spark, sf))
    work = {
        "rolling_stats": lambda k: rolling_stats(table[k], METRICS, tables.ORDER),
        "rolling_mean_std": lambda k: rolling_mean_std(table[k], METRICS, tables.ORDER),
        "build_features": lambda k: build_features(table[k], METRICS, tables.ORDER, dense=True),
    }
    rate = {}
    for name, op in work.items():
        run(op(1))
        for k in table:
            rate[f"{name}_x{k}"] = round(n * k / timed(lambda k=k: run(op(k))))
    run(impute_linear(raw, METRICS, tables.ORDER))
    rate["impute_linear_x1"] = round(n / timed(lambda: run(impute_linear(raw, METRICS, tables.ORDER))))
    rate["rolling_mean_std_valid_x1"] = round(n / timed(lambda: run(rolling_mean_std_valid(raw, METRICS, tables.ORDER))))
    rate["rolling_mean_std_valid_x4"] = round(4 * n / timed(lambda: run(rolling_mean_std_valid(table[4], METRICS, tables.ORDER))))
    print(json.dumps({"metric": "total_time", "value": round(sum(queries.values()), 3), "unit": "sec", "queries": queries,
                      "sf": Path(sf).name.removeprefix("sf"), "rows": n, "rows_per_sec": rate, "cold": cold}))


if __name__ == "__main__":
    main()
