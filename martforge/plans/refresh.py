"""Mart refresh: the five refined tables from the current trusted snapshots.

The reference replaces each mart with ``CREATE OR REPLACE TABLE … AS
SELECT``. Here each mart is written as a new version folder; one commit row
then makes the whole refresh current, so readers never see a half-written
mart or a mix of two refreshes; a failed refresh leaves the previous marts
current. The marts read the trusted snapshots
that are current when the refresh starts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..config import TableSpec
from ..operators import marts
from ..operators.marts import StarSpec
from ..session import in_bounded_tasks, shuffle_partitions_for
from ..sources import layers as L

ROLES = ("detail", "header", "customer", "product", "person")
MART_NAMES = ("pedidos", "cliente", "produto", "tempo", "vendedor")


def build_marts(sources: dict[str, DataFrame], star: StarSpec) -> dict[str, DataFrame]:
    """The five marts as lazy DataFrames (fact ``pedidos`` and four dimensions)."""
    d, h = sources["detail"], sources["header"]
    return {
        "pedidos": marts.fact_orders(d, h, star),
        "cliente": marts.customer_dim(sources["customer"], star),
        "produto": marts.product_dim(sources["product"], star),
        "tempo": marts.time_dim(sources["product"], d, h, star),
        "vendedor": marts.salesperson_dim(h, d, sources["person"], star),
    }


@in_bounded_tasks
def refresh_marts(
    spark: SparkSession,
    layout: L.LakeLayout,
    star: StarSpec,
    specs: dict[str, TableSpec],
    prepare: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    run_id: str | None = None,
    keep_versions: int = 0,
) -> dict[str, str]:
    """Write and commit every mart; returns ``{mart: version}``.

    ``specs`` maps each role in ``ROLES`` to its table; ``prepare`` may
    derive columns a role lacks (applied lazily, inside the same plan).
    Refreshes older than the newest ``keep_versions`` are deleted (0 keeps all).
    """
    prepare = prepare or {}
    after = L.commit_number(spark, layout.refined_root)
    sources, size = {}, 0
    for role in ROLES:
        version = L.current_version(spark, layout, specs[role])
        if version is not None:
            size += L.version_bytes(spark, layout, specs[role], version)
        # the modification date is the load's, not the marts'
        df = L.read_trusted_version(spark, layout, specs[role], version).drop("partition_time", *filter(None, [specs[role].modified]))
        sources[role] = prepare[role](df) if role in prepare else df
    shuffle_partitions_for(spark, size)
    run = run_id or uuid.uuid4().hex[:12]
    # the five writes are independent jobs: submit them together so small
    # marts run beside the fact instead of after it (the scheduler shares the
    # executors); any failure is raised here, before the commit
    with ThreadPoolExecutor(max_workers=len(MART_NAMES)) as pool:
        jobs = {name: pool.submit(L.write_version, df, layout.refined(name), run)
                for name, df in build_marts(sources, star).items()}
        for job in jobs.values():
            job.result()
    written = {name: run for name in jobs}
    # one commit row for the whole refresh, after every mart is written:
    # readers switch all five marts at once
    L.commit_version(spark, layout.refined_root, run, run, None, after)
    # refreshes older than the newest ``keep_versions`` (0: none) are deleted
    L.expire_versions(spark, layout.refined_root, keep_versions,
                      tuple(layout.refined(name) for name in MART_NAMES))
    return written


def read_mart(spark: SparkSession, layout: L.LakeLayout, name: str) -> DataFrame | None:
    """A mart as of the latest committed refresh (None before the first)."""
    run = L.current_version_at(spark, layout.refined_root)
    return None if run is None else spark.read.parquet(f"{layout.refined(name)}/v={run}")
