"""Time the headline queries; one JSON line on standard output.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs once cold and BENCH_RUNS (default 2) times more, of which the best counts; results
go to a sink that reads every row and keeps none. Rates are over the rows that a query works on.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskspark.operators.models import fit_logistic  # noqa: E402
from riskspark.plans.queries import QUERIES, modelling  # noqa: E402
from riskspark.plans.queries.base import rows as cleaned  # noqa: E402
from riskspark.session import local_session  # noqa: E402

# Query, and the rows that it really works on.
HEADLINES = {
    "asof_history": "orders",
    "pr_curve": "orders",
    "metrics_by_split": "orders of val and test",
    "psi_numeric": "orders of train and test",
    "psi_categorical": "orders of train and test",
    "failing_cells": "orders",
    "feedback_rows": "orders",
    "latency_quantiles": "events",
    "alerts_per_sliding_hour": "events",
    # Measures, preparation, fit and scores of all documents, nothing kept from an earlier run.
    "logistic_scores": "documents",
}


def timed(df_of) -> float:
    start = time.perf_counter()
    df_of().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores=cpus, memory="16g", partitions=int(cpus))
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("orders", "events", "documents")}
    parts = dict(cleaned(spark, sf_dir).groupBy("split").count().collect())
    rows["orders of val and test"] = parts["val"] + parts["test"]
    rows["orders of train and test"] = parts["train"] + parts["test"]
    seconds, cold = {}, {}
    for name in HEADLINES:
        took = [timed(lambda name=name: QUERIES[name](spark, sf_dir)) for _ in range(runs + 1)]
        cold[name], seconds[name] = round(took[0], 3), round(min(took[1:]), 3)
    per_second = {n: round(rows[t] / seconds[n]) for n, t in HEADLINES.items()}
    # The model step alone: vectors written and the model fitted beforehand, all documents scored.
    vectors, _ = modelling.prepared_documents(spark, sf_dir)
    model = fit_logistic(modelling.for_fitting(modelling.split_of(vectors, "train")))
    step = min(timed(lambda: modelling.scores(vectors, model, "1")) for _ in range(runs + 1))
    seconds["model_step"] = round(step, 3)
    per_second["model_step"] = round(rows["documents"] / step)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold": cold,
                "rows_per_sec": per_second,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
