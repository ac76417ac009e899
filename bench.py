"""Wall-clock seconds of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from checks.queries import run_check  # noqa: E402
from clientele.session import build_session  # noqa: E402

HEADLINE = [
    "clean_lines", "engineer_features", "summary_statistics", "correlation_matrix",
    "iqr_outliers", "robust_scale", "isolation_forest", "kmeans", "hierarchical",
    "gaussian_mixture", "consensus_clustering", "kmeans_sweep", "silhouette_samples",
    "dbscan_core_points", "dbscan", "gap_statistic", "anova", "segment_report", "run_analysis",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cores}]",
        spark__sql__shuffle__partitions=cores,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first query would otherwise pay for starting the JVM's compilers and the workers.
    run_check("isolation_forest")(spark, "/root/testdata/sf0.001").count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run_check(name)(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
