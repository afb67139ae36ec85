"""The daily job: load what is new, rebuild the models, check them."""

from __future__ import annotations

import dataclasses
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfscan import schemas
from shelfscan.operators import require
from shelfscan.plans import mart as mart_plan
from shelfscan.plans import staging as staging_plan
from shelfscan.plans.ingest import ingest, load_name, merge_into_raw, read_changes, read_raw
from shelfscan.plans.quality import mart_checks, staging_checks
from shelfscan.sources.dimensions import health_claims, load_seed
from shelfscan.sources.parts import delete_folder
from shelfscan.sources.state import LoadState, append_state, read_state
from shelfscan.sources.tables import materialize, read_table


MART = "mart_deceptive_by_category"
MODELS = {"stg_products": schemas.STAGING, MART: schemas.MART}


def run_load(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    scope: str = "brazil",
    buckets: int | None = None,
    inclusive: bool = False,
    log_changes: bool = False,
) -> LoadState:
    """Merges the products changed since the last load of this scope."""
    name = load_name(scope)
    cutoff = read_state(spark, f"{root}/state", name).cursor
    delta = ingest(source, scope, cutoff, inclusive)
    return merge_into_raw(spark, delta, root, name, buckets=buckets, log_changes=log_changes)


def models_name(scope: str, backend: str = "spark") -> str:
    """The name under which the state of a scope's models is kept."""
    return f"models_{backend}_{scope.lower()}"


def model_path(root: str, scope: str, backend: str, model: str, version: int) -> str:
    """Where a version of a model is written."""
    return f"{root}/{quote(models_name(scope, backend), safe='')}/{model}/version={version}"


def read_model(spark: SparkSession, root: str, model: str, scope: str = "brazil", backend: str = "spark") -> DataFrame:
    """The published version of a model; raises if there is none."""
    state = read_state(spark, f"{root}/state", models_name(scope, backend))
    if not state.version:
        raise LookupError(f"no models of scope {scope!r} were built from {backend} loads under {root}")
    return read_table(spark, model_path(root, scope, backend, model, state.version), MODELS[model])


def register_views(
    spark: SparkSession,
    root: str,
    scope: str = "brazil",
    claims: DataFrame | None = None,
    backend: str = "spark",
) -> None:
    """Names the tables of a scope in the session, for ``spark.table`` and SQL."""
    views = {
        "raw_products": read_raw(spark, root, load_name(scope, backend)),
        "health_claims": health_claims(spark) if claims is None else claims,
        **{model: read_model(spark, root, model, scope, backend) for model in MODELS},
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def run_models(
    spark: SparkSession,
    root: str,
    scope: str = "brazil",
    claims: DataFrame | None = None,
    backend: str = "spark",
) -> tuple[DataFrame, DataFrame]:
    """Rebuilds staging and mart of a scope from its raw table; returns both as published.

    Each build writes new folders: staging is written and checked, then the mart
    is, and only then does the state name them. A build that fails, or whose
    checks do, leaves readers the version they had; the next build writes the same
    folders anew. Older versions stay until they are deleted.
    """
    name = load_name(scope, backend)
    if not read_state(spark, f"{root}/state", name).version:
        raise LookupError(f"load {name} never ran under {root}")
    claims = health_claims(spark) if claims is None else claims
    state = read_state(spark, f"{root}/state", models_name(scope, backend))
    paths = {m: model_path(root, scope, backend, m, state.version + 1) for m in MODELS}

    staging = staging_plan.build_staging(read_raw(spark, root, name), claims)
    layout = {"partition_by": staging_plan.PARTITION_BY, "cluster_by": staging_plan.CLUSTER_BY}
    materialize(staging, paths["stg_products"], **layout)
    stg = read_table(spark, paths["stg_products"], schemas.STAGING)
    require(staging_checks(stg))

    materialize(mart_plan.build_mart(stg), paths[MART], cluster_by=mart_plan.CLUSTER_BY)
    mart = read_table(spark, paths[MART], schemas.MART)
    require(mart_checks(mart))

    append_state(spark, f"{root}/state", dataclasses.replace(state, version=state.version + 1))
    return stg, mart


def remove_old_models(spark: SparkSession, root: str, scope: str = "brazil", backend: str = "spark", keep: int = 2) -> list[str]:
    """Deletes the models' versions before the last ``keep`` published ones; returns what was deleted.

    A build that failed left the folders of the version after the published one: they stay,
    the next build replaces them.
    """
    published = read_state(spark, f"{root}/state", models_name(scope, backend)).version
    removed = []
    for model in MODELS:
        for version in range(1, published - keep + 1):
            path = model_path(root, scope, backend, model, version)
            if delete_folder(spark, path):
                removed.append(path)
    return removed


def counts_name(scope: str, backend: str = "spark") -> str:
    """The name under which the state of a scope's category counts is kept."""
    return f"category_counts_{backend}_{scope.lower()}"


def update_mart(
    spark: SparkSession,
    root: str,
    scope: str = "brazil",
    claims: DataFrame | None = None,
    backend: str = "spark",
    rebuild: bool = False,
) -> DataFrame:
    """The mart's rows after all loads so far, from stored counts and what loads changed since.

    Only the products that loads put in or replaced since the last call are staged and
    counted (loads must run with ``log_changes``). The first call, a load without a log, and
    ``rebuild`` (needed where the claims changed) count the whole raw table. The state
    names the load that the counts stand for, so each load is counted once,
    whatever fails in between.
    """
    claims = health_claims(spark) if claims is None else claims
    raw = read_state(spark, f"{root}/state", load_name(scope, backend))
    if not raw.version:
        raise LookupError(f"load {load_name(scope, backend)} never ran under {root}")
    name = counts_name(scope, backend)
    state = read_state(spark, f"{root}/state", name)
    path = lambda version: f"{root}/{quote(name, safe='')}/version={version}"
    counted = state.cursor  # the load that the counts stand for
    if counted != raw.version or rebuild:
        signed = None if rebuild or not state.version else read_changes(spark, root, load_name(scope, backend), counted)
        if signed is None:
            counts = mart_plan.category_counts(staging_plan.build_staging(read_raw(spark, root, load_name(scope, backend)), claims))
        else:
            gone, come = (
                staging_plan.build_staging(signed.filter(F.col("sign") == s).drop("sign"), claims) for s in (-1, 1)
            )
            counts = mart_plan.changed_counts(read_table(spark, path(state.version), schemas.CATEGORY_COUNTS), gone, come)
        state = LoadState(name, state.version + 1, raw.version)
        materialize(counts, path(state.version), cluster_by=mart_plan.CLUSTER_BY)
        append_state(spark, f"{root}/state", state)
    return mart_plan.mart_of(read_table(spark, path(state.version), schemas.CATEGORY_COUNTS))


def run_build(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    scope: str = "brazil",
    buckets: int | None = None,
    seed: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Load, models and checks of a scope under one root; raises if a check fails.

    ``seed``: a CSV of claim tags and families, read on every build; the packaged one if left out.
    """
    run_load(spark, source, root, scope, buckets)
    claims = load_seed(spark, seed, schemas.HEALTH_CLAIMS) if seed else None
    return run_models(spark, root, scope, claims)
