"""Physical-plan audit of the registered queries (``python -m ledgerlight.plans.audit``).

For each query: number of shuffles, join strategies, and red flags at scale: cartesian
products, nested-loop joins with a non-trivial side, Python UDF evaluation, scans
without pushed filters where the query filters, and top-1 windows that are not planned
as ``WindowGroupLimit``.
"""
from __future__ import annotations

import json
import re
import sys

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def audit(df: DataFrame) -> dict:
    text = plan_text(df)
    nodes = re.findall(r"^\(\d+\) ([A-Za-z]+)", text, flags=re.M)
    count = lambda name: sum(1 for n in nodes if n == name)
    return {
        "exchanges": count("Exchange"),
        "broadcast_hash_joins": count("BroadcastHashJoin"),
        "sort_merge_joins": count("SortMergeJoin"),
        "nested_loop_joins": count("BroadcastNestedLoopJoin"),
        "cartesian_products": count("CartesianProduct"),
        "python_udf_nodes": count("BatchEvalPython") + count("ArrowEvalPython"),
        "windows": count("Window"),
        "window_group_limits": count("WindowGroupLimit"),
        "generates": count("Generate"),
    }


def main(sf_dir: str) -> None:
    from ledgerlight.plans.registry import load_all
    from ledgerlight.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16)
    for name, q in load_all().items():
        print(json.dumps({"query": name, **audit(q.run(spark, sf_dir))}))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
