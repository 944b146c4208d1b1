"""

Usage: python tools/experiments.py [sf_dir] [scratch_dir]

1. report_status: size-proven broadcast of the nation dimension vs a forced
   sort-merge join for the same lookup.
2. filter_between: the date range on the raw timestamp (pushed to Parquet)
   vs the same range on ``date_format`` text (not pushed).  Run on a copy of
   orders sorted by date and written with small row groups, so min/max
   statistics can skip row groups; the source files hold one row group each.
3. cond_agg_pivot: one pass of conditional sums vs one aggregate per
   category joined back by date.

Prints one JSON line with best-of-3 seconds per variant.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from relq.functions import expressions as X  # noqa: E402
from relq.operators import aggregates as A  # noqa: E402
from relq.operators import joins as J  # noqa: E402
from relq.operators import ordering as O  # noqa: E402
from relq.plans import catalog as C  # noqa: E402
from relq.session import local_session  # noqa: E402


def best(df, n=3) -> float:
    times = []
    for _ in range(n):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return round(min(times), 3)


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else None
    spark = local_session(8)
    out = {"sf_dir": d}

    # 1. dimension join strategy
    out["report_status_broadcast_dim"] = best(C.report_status(spark, d))
    fact = C._orders_with_nation(spark, d)
    merged = fact.join(C.nation_dim(spark, d).hint("merge"), fact["c_nationkey"] == F.col("n_nationkey"))
    label = X.case_map("o_orderstatus", C.STATUS_LABELS, "other")
    smj = A.group_then_label(merged, ["basis_year", "n_name", "zone"], "o_orderstatus", label, "status_name",
                             [A.count_rows("n_orders"),
                              X.round_to(X.money_sum("o_totalprice"), 1).alias("total_price")])
    out["report_status_sort_merge_dim"] = best(O.order_by(smj, ["-basis_year", "-n_orders", "n_name", "status_name"]))

    # 2. pushed vs unpushed date predicate on a date-clustered copy
    if scratch:
        copy = os.path.join(scratch, "orders_by_date")
        if not os.path.exists(copy):
            (C.t(spark, d, "orders").orderBy("o_orderdate").coalesce(1).write
             .option("parquet.block.size", 256 * 1024).parquet(copy))
        orders = spark.read.schema(C.t(spark, d, "orders").schema).parquet(copy)
        lo, hi = X.ts("1997-01-01 00:00:00"), X.ts("1997-03-31 00:00:00")
        pushed = orders.filter(F.col("o_orderdate").between(lo, hi))
        text = X.date_text("o_orderdate")
        unpushed = orders.filter(text.between(F.lit("19970101"), F.lit("19970331")))
        assert pushed.count() == unpushed.count()
        out["filter_between_pushed"] = best(pushed)
        out["filter_between_date_format"] = best(unpushed)

    # 3. one-pass conditional sums vs one aggregate per category
    li = C.t(spark, d, "lineitem").withColumn("basis_year", X.date_text("l_shipdate", "yyyy"))
    out["pivot_one_pass"] = best(A.pivot_sums(li, ["basis_year"], "l_returnflag",
                                              {"r": "R", "a": "A", "n": "N"}, "l_quantity", "total"))
    parts = [A.group_agg(li.filter(F.col("l_returnflag") == v), ["basis_year"], [F.sum("l_quantity").alias(k)])
             for k, v in {"r": "R", "a": "A", "n": "N"}.items()]
    joined = A.group_agg(li, ["basis_year"], [F.sum("l_quantity").alias("total")])
    for p in parts:
        joined = J.equi_join(joined, p, "basis_year", how="left")
    out["pivot_join_per_category"] = best(joined)

    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
