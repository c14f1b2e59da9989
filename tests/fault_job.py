"""Run ordered operators over an input whose first task attempts fail.

Started by tests/test_faults.py in its own process with master local[2,4]
(task retries on).  Prints one JSON line with the results to compare.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark import TaskContext
    from pyspark.sql import functions as F

    from cardpanel.operators.evaluation import average_precision
    from cardpanel.operators.ordered import exact_ranks
    from cardpanel.session import build_session

    spark = build_session("local[2,4]", shuffle_partitions=4, app="cardpanel-faults")
    rows = [(i, ((i * 7919) % 1000) / 1000.0, int((i * 31) % 5 == 0)) for i in range(3000)]
    base = spark.createDataFrame(rows, "customer_id long, risk_score double, default_next_month int").repartition(6)

    def flaky(batches):
        ctx = TaskContext.get()
        for pdf in batches:
            if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
                raise RuntimeError("injected executor failure")
            yield pdf

    faulty = base.mapInPandas(flaky, base.schema)
    ap = average_precision(faulty, rows_per_block=500).first()[0]
    ranks = exact_ranks(faulty, ["risk_score", "customer_id"], ["default_next_month"], rows_per_block=400)
    bad = ranks.groupBy("default_next_month").agg(
        (F.max("rank") - F.count(F.lit(1)) + 1).alias("gap"), F.countDistinct("rank").alias("d"),
        F.count(F.lit(1)).alias("n")).collect()
    print(json.dumps({"ap": ap, "ranks_ok": all(r["gap"] == 0 and r["d"] == r["n"] for r in bad),
                      "clean_ap": average_precision(base, rows_per_block=500).first()[0]}))
    spark.stop()


if __name__ == "__main__":
    main()
