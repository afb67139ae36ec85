"""Command line: ``build`` runs the daily job, ``report`` shows one report of its tables.

    spark-submit --py-files shelfscan.zip shelfscan/__main__.py build EXPORT ROOT
    python -m shelfscan report tile2_claims ROOT --scope brazil
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfscan import spark_session
from shelfscan.plans import reports
from shelfscan.plans.build import read_model, run_build
from shelfscan.sources import (
    additive_families,
    additive_refs,
    category_groups,
    read_modified_after,
    read_products,
)

#: Report name to its function and the dimensions it joins.
REPORTS = {
    "kpis": (reports.kpis,),
    "tile1_paradox": (reports.tile1_paradox,),
    "tile1_raw_pct": (reports.tile1_raw_pct,),
    "tile2_claims": (reports.tile2_claims,),
    "tile3_category_groups": (reports.tile3_category_groups, category_groups),
    "tile4_top_brands": (reports.tile4_top_brands,),
    "tile5_additives": (reports.tile5_additives, additive_families),
    "tile5_references": (reports.tile5_references, additive_families, additive_refs),
    "tile6_additive_gap": (reports.tile6_additive_gap,),
    "total_products": (reports.total_products,),
    "nova_distribution": (reports.nova_distribution,),
    "claims_by_nova": (reports.claims_by_nova,),
    "paradox_products": (reports.paradox_products,),
    "deceptive_brands": (reports.deceptive_brands,),
    "claims_on_nova4": (reports.claims_on_nova4,),
}


def report(spark: SparkSession, name: str, root: str, scope: str, backend: str = "spark") -> DataFrame:
    """A report over the staging table written under a root."""
    make, *dimensions = REPORTS[name]
    stg = read_model(spark, root, "stg_products", scope, backend)
    return make(stg, *(dimension(spark) for dimension in dimensions))


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfscan", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", help="load an export, rebuild and check the models")
    build.add_argument("source", help="Parquet export")
    build.add_argument("--buckets", type=int, help="buckets of the raw table")
    build.add_argument("--seed", help="CSV of claim tags and families; the packaged one if left out")
    build.add_argument(
        "--modified-after",
        type=dt.datetime.fromisoformat,
        help="take only files changed after this moment (UTC)",
    )
    shown = commands.add_parser("report", help="show a report")
    shown.add_argument("name", choices=sorted(REPORTS))
    shown.add_argument("--backend", choices=["spark", "stream"], default="spark", help="load the models are from")
    for command in (build, shown):
        command.add_argument("root", help="folder of the tables")
        command.add_argument("--scope", default="brazil")
    chosen = parser.parse_args(arguments)

    spark = spark_session()
    if chosen.command == "build":
        if chosen.modified_after:
            source = read_modified_after(spark, chosen.source, chosen.modified_after)
        else:
            source = read_products(spark, chosen.source)
        run_build(spark, source, chosen.root, chosen.scope, chosen.buckets, chosen.seed)
    else:
        rows = report(spark, chosen.name, chosen.root, chosen.scope, chosen.backend).persist()
        rows.show(max(rows.count(), 1), truncate=False)


if __name__ == "__main__":
    main()
