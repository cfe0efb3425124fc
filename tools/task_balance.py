"""Task times of the sentence split with and without length balancing: ``python tools/task_balance.py [sf_dir] [tasks]``.

Reads them from Spark's event log, for the stage that writes the sentences.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from forumlens.operators.balance import balance_by_length  # noqa: E402
from forumlens.operators.sentences import clean_columns, explode_sentences, keyword_rows, union_sources  # noqa: E402
from forumlens.runtime import materialize, ship_package  # noqa: E402
from forumlens.workload import bindings as B  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    tasks = int(sys.argv[2]) if len(sys.argv) > 2 else 22
    logs = tempfile.mkdtemp(prefix="events-")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{logs}")
        .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.files.maxPartitionBytes", "4m").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)

    def split(name: str, source) -> None:
        spark.sparkContext.setLocalProperty("forumlens.run", name)
        rows = keyword_rows(explode_sentences(source), B.LEXICON)
        rows.write.format("noop").mode("overwrite").save()
        spark.sparkContext.setLocalProperty("forumlens.run", None)

    source = materialize(union_sources(clean_columns(B.posts(spark, sf)), clean_columns(B.comments(spark, sf))), "cleaned")
    split("warm", source)
    # by source_id alone, as files grouped by community and id would be
    split("ordered files", source.repartitionByRange(tasks, "source_id"))
    split("balanced", balance_by_length(source, "content", ["source_id"], tasks=tasks, ranges=tasks))
    spark.stop()

    stages: dict[tuple[int, int], str] = {}
    times: dict[str, dict[int, list[int]]] = {}
    for path in glob.glob(f"{logs}/*"):
        for line in open(path):
            event = json.loads(line)
            if event["Event"] == "SparkListenerStageSubmitted":
                run = (event.get("Properties") or {}).get("forumlens.run")
                if run:
                    stages[event["Stage Info"]["Stage ID"]] = run
            elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in stages:
                info = event["Task Info"]
                run = times.setdefault(stages[event["Stage ID"]], {})
                run.setdefault(event["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
    for run, by_stage in times.items():
        last = by_stage[max(by_stage)]
        median = statistics.median(last)
        print(f"{run:14s} tasks {len(last):3d}  median {median:6.0f} ms  max {max(last):6d} ms  max/median {max(last) / median:.2f}")


if __name__ == "__main__":
    main()
