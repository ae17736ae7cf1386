"""Benchmark the headline queries; prints one JSON line.

Environment:
  BENCH_SF_DIR  scale-factor folder (default /root/testdata/sf0.1)
  BENCH_CPUS    local cores (default 8)
  BENCH_RUNS    timed warm runs per query, best kept (default 2)
  BENCH_EVENT_LOG_DIR  if set, Spark's event log is written there (stage/task
                times: ``python tools/stage_times.py <dir>``)

Each query is executed to completion with the ``noop`` sink (the whole plan
runs, nothing is collected). The first run of a query is reported as
``cold``; ``queries`` holds the best warm run. The headline value is the sum
of warm times.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sentinela.plans.catalog import QUERIES  # noqa: E402
from sentinela.session import build_session  # noqa: E402

HEADLINE = [
    "gold_fraude_estado", "gold_por_hora", "gold_perfil_risco", "gold_diario",
    "gold_fraude_estado_multi", "gold_perfil_risco_multi", "gold_diario_multi",
    "insight_top_estados", "clean_transacoes", "quality_report", "audit_fk_orphans", "audit_unique",
    "vw_transacoes_completa", "velocity_trailing", "alert_documents", "stream_alerts",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    shuffle = max(cpus, 8)
    extra = {"spark.driver.memory": "16g"}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = build_session(f"local[{cpus}]", app="sentinela-bench", shuffle_partitions=shuffle, extra=extra)
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(run(spark, name, sf_dir), 3)
        warm[name] = round(min(run(spark, name, sf_dir) for _ in range(runs)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum_warm_query_sec", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "shuffle_partitions": shuffle, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
