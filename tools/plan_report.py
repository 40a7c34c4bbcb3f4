"""Summarise the physical plan of every registered query.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

Per query: shuffles (Exchange), broadcasts, sort-merge joins, partial
WindowGroupLimit (per-key limits applied before the shuffle), scans with
partition / pushed filters, and whether any Python UDF appears.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(df) -> dict:
    jvm = df.sparkSession.sparkContext._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    ops = re.findall(r"^\(\d+\) ([A-Za-z]+)", text, flags=re.M)
    count = lambda name: sum(1 for o in ops if o == name)
    return {
        "exchanges": count("Exchange"),
        "broadcasts": count("BroadcastExchange"),
        "smj": count("SortMergeJoin"),
        "bhj": count("BroadcastHashJoin"),
        "partial_limit": len(re.findall(r"row_number\(\), \d+, Partial", text)),
        "partition_filters": len(re.findall(r"PartitionFilters: \[[^\]]", text)),
        "pushed_filters": len(re.findall(r"PushedFilters: \[[^\]]", text)),
        "bodies_moved": sum("body#" in x for x in re.findall(
            r"^\(\d+\) (?:Broadcast)?Exchange\n(?:Output|Input) ?(?:\[\d+\])?: \[([^\n]*)\]", text, flags=re.M)),
        "python_udf": ("BatchEvalPython" in text) or ("ArrowEvalPython" in text),
    }


def main() -> None:
    from pyspark.sql import SparkSession

    from boardlake.plans import queries as Q

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plan summary of the registered queries\n")
    print(f"Generated by `python tools/plan_report.py {sf}` (initial adaptive plans; AQE may turn shuffle joins "
          "into broadcasts at run time once sizes are known).\n")
    print("| query | exchanges | broadcast joins | sort-merge joins | partial per-key limits | scans with partition filters | scans with pushed filters | exchanges of bodies | Python UDF |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in sorted(Q.spark_queries().items()):
        s = summarise(fn(spark, sf))
        print(f"| {name} | {s['exchanges']} | {s['bhj']} | {s['smj']} | {s['partial_limit']} | "
              f"{s['partition_filters']} | {s['pushed_filters']} | {s['bodies_moved']} | {'yes' if s['python_udf'] else 'no'} |")


if __name__ == "__main__":
    main()
