"""The production run: build and publish the mart once, then every report from the written mart.

Stages and hand-offs are written tables under one base folder (by default the shared
``spark.checkpoint.dir``): the exact mart (partitioned by year) is the lineage cut, so a lost
executor during the reports recomputes at most one report stage, never the fact joins. The mart and
its public form go under names of the session catalogue, each load beside the one before
(``publish.publish_table``), so their readers never see a gap and a failed run changes nothing.

The checks ride along: the mart's own figures (rows, rows without days, unknown members, Q4 / Q5)
are observed while it is written (``quality.Watch``), without another scan. Each run appends
one row to the load audit that feeds the dashboard's status panel (G12): the 'loaded' text when the
run finished and the facts reconcile with the published mart over the years that it wrote (Q3), the
'problem' text otherwise, with the observed figures beside it.
"""

from __future__ import annotations

import dataclasses
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from staffmart.config import ReportYears
from staffmart.operators import mart as M
from staffmart.operators import quality as Q
from staffmart.operators.publish import publish_table, record_load
from staffmart.plans.registry import _REGISTRY, BUDGET_QUERIES, WRITERS, Context, available, context
from staffmart.session import warehouse_path

MART_TABLE = "mart_exact"
BUDGET_TABLE = "mart_exact_budget"
PUBLIC_TABLE = "dwh_personeel_fte"


def run(spark: SparkSession, sf_dir: str | None = None, base: str | None = None, names: list[str] | None = None,
        current_year_only: bool = False, ctx: Context | None = None, database: str | None = None) -> dict[str, str]:
    """Publish the mart and write the reports; returns the folder of each report, and the mart's
    public name. ``current_year_only`` recomputes just the current year: year-to-date sums never
    cross a year, and only the current year's partition is replaced, so the previous year's stays as
    published and the fact scan halves. A full run replaces the whole mart, so years that left the
    report period go.

    ``ctx`` runs over any personnel tables (``registry.context_for``); queries whose optional
    inputs (event table, KPI table, relation lookups) are missing are skipped."""
    base = base or warehouse_path(spark, "staffmart")
    ctx = full = ctx if ctx is not None else context(spark, sf_dir)
    named = lambda table: f"{database}.{table}" if database else table
    if current_year_only:
        cur = ctx.years.current
        ctx = dataclasses.replace(ctx, only_years=ReportYears(current=cur, previous=cur), _marts={})
    outputs: dict[str, str] = {}
    ok = False
    figures: dict[str, int] = {}
    reported = F.col("jaar").isin([str(y) for y in full.years.both])
    try:
        watch = Q.Watch()
        built = watch.mart(M.fte_mart(ctx.period, ctx.years, ctx.options, watch.facts))
        published = publish_table(built, base, named(MART_TABLE), only_its_partitions=current_year_only).where(reported)
        figures = watch.figures
        publish_table(M.display(published, with_load_time=True), base, named(PUBLIC_TABLE))
        outputs[PUBLIC_TABLE] = named(PUBLIC_TABLE)
        names = names or [n for n in _REGISTRY if n not in WRITERS and available(full, n)]
        # reports cover the full report period over every published year
        marts = {False: published}
        if BUDGET_QUERIES & set(names):
            # one budget mart for all reports on it
            marts[True] = publish_table(ctx.mart(include_budget=True), base, named(BUDGET_TABLE), only_its_partitions=current_year_only).where(reported)
        run_ctx = dataclasses.replace(full, _marts=marts)
        for name in names:
            path = os.path.join(base, "reports", name)
            _REGISTRY[name](run_ctx).write.mode("overwrite").parquet(path)
            outputs[name] = path
        # the control step: facts entering the mart must add up to the published mart
        written = published.where(F.col("jaar").isin([str(y) for y in ctx.years.both]))
        rec = Q.reconciliation(ctx.period, ctx.years, ctx.options, written)
        ok = not rec.filter(~F.coalesce(F.col("sluit"), F.lit(False))).take(1)
        return outputs
    finally:
        record_load(spark, os.path.join(base, "load_audit"), PUBLIC_TABLE, figures.get("mart_rijen"), ok, figures=figures)
