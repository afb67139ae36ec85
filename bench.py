"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local
cores. The catalogue is derived and landed first, as the export a user would
have. Then every job is run once to warm up and ``BENCH_RUNS`` times measured;
the median counts. Reports read the staging table, as they do in use; its build
has its own entry.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from shelfscan import schemas, spark_session
from shelfscan.operators import upsert
from shelfscan.plans import reports
from shelfscan.plans.ingest import ingest, merge_into_raw
from shelfscan.plans.mart import build_mart
from shelfscan.plans.quality import run_checks
from shelfscan.plans.staging import CLUSTER_BY, PARTITION_BY, build_staging
from shelfscan.sources import (
    additive_families,
    additive_refs,
    category_groups,
    health_claims,
    materialize,
    read_products,
    read_table,
)
from shelfscan.testbed.products import product_updates, products

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def consume(df) -> None:
    """Runs a query to its last row without bringing rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def scale_factor(folder: str) -> float | str:
    """The number in a folder name like ``sf0.1``, or the name."""
    name = os.path.basename(folder.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    work = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("BENCH_WORK_DIR", "/tmp"))
    spark = spark_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.warehouse.dir": f"{work}/warehouse",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    export, updates, staged = f"{work}/export", f"{work}/updates", f"{work}/stg_products"
    products(spark, SF_DIR).write.parquet(export)
    product_updates(spark, SF_DIR).write.parquet(updates)

    claims = health_claims(spark)
    groups, families, refs = (f(spark) for f in (category_groups, additive_families, additive_refs))
    source = read_products(spark, export)

    def build(path: str) -> None:
        materialize(
            build_staging(ingest(source), claims),
            path,
            partition_by=PARTITION_BY,
            cluster_by=CLUSTER_BY,
        )

    def merge() -> None:
        delta = ingest(read_products(spark, updates))
        consume(upsert(ingest(source), delta, ["code"], "last_modified_t"))

    def load(path: str) -> None:
        """The production load: bucketed read, merge, write, cursor."""
        merge_into_raw(spark, ingest(read_products(spark, path)), f"{work}/tables", "bench")

    load(export)
    build(staged)
    stg = read_table(spark, staged, schemas.STAGING)

    def on_staging(report, *dimensions):
        return lambda: consume(report(stg, *dimensions))

    jobs = {
        "ingest": lambda: consume(ingest(source)),
        "upsert_raw": merge,
        "merge_into_raw": lambda: load(updates),
        "stg_products": lambda: build(f"{work}/rebuilt"),
        "mart_deceptive_by_category": on_staging(build_mart),
        "dq_report": on_staging(lambda stg: run_checks(stg, build_mart(stg))),
        "kpis": on_staging(reports.kpis),
        "tile1_paradox": on_staging(reports.tile1_paradox),
        "tile2_claims": on_staging(reports.tile2_claims),
        "tile3_category_groups": on_staging(reports.tile3_category_groups, groups),
        "tile4_top_brands": on_staging(reports.tile4_top_brands),
        "tile5_additives": on_staging(reports.tile5_additives, families),
        "tile5_references": on_staging(reports.tile5_references, families, refs),
        "tile6_additive_gap": on_staging(reports.tile6_additive_gap),
        "nova_distribution": on_staging(reports.nova_distribution),
        "claims_by_nova": on_staging(reports.claims_by_nova),
        "paradox_products": on_staging(reports.paradox_products),
        "deceptive_brands": on_staging(reports.deceptive_brands),
        "claims_on_nova4": on_staging(reports.claims_on_nova4),
        "product_search": on_staging(reports.product_search, "Leite%Integral%", "%Laticínios%"),
    }
    taken = {}
    for name, job in jobs.items():
        job()
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            job()
            times.append(time.perf_counter() - start)
        taken[name] = round(statistics.median(times), 3)
        print(f"{name}: {taken[name]}", file=sys.stderr)

    result = {
        "metric": "total_query_time",
        "value": round(sum(taken.values()), 3),
        "unit": "sec",
        "queries": taken,
        "sf": scale_factor(SF_DIR),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
