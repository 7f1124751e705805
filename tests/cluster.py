"""Run in a process of its own: queries on executors that are processes apart. Arguments: shared folder, input folder, queries."""

import json
import os
import sys

from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def main(shared: str, sf_dir: str, *names: str) -> None:
    os.chdir(shared)
    spark = (
        SparkSession.builder.master("local-cluster[2,1,1024]").appName("cluster").config("spark.executor.memory", "900m").config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", f"file://{shared}/checkpoints").config("spark.local.dir", f"{shared}/local").getOrCreate()
    )
    sys.path.insert(0, HERE)
    import __spark_entry__ as e

    for name in names:
        # Twice: a query may not depend on what its last run has left.
        print("RESULT", json.dumps([name, *(sorted(list(r.asDict().items()) for r in e.queries()[name](spark, sf_dir).collect()) for _ in range(2))]))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
