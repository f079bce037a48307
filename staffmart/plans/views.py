"""The personnel tables, the mart and every report as temporary views for ``spark.sql`` users."""

from __future__ import annotations

from staffmart.operators import mart as M
from staffmart.plans.registry import _REGISTRY, WRITERS, Context, available

PUBLIC_MART = "dwh_personeel_fte"


def register_views(ctx: Context, prefix: str = "") -> list[str]:
    """Create or replace temp views (lazy plans; nothing is computed until queried).

    Returns the view names: the personnel tables, ``dwh_personeel_fte`` and one view per
    registered query whose inputs are available (stream and sinks are left out)."""
    names = []
    for name, df in ctx.tables.views().items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    M.display(ctx.mart()).createOrReplaceTempView(prefix + PUBLIC_MART)
    names.append(prefix + PUBLIC_MART)
    for name, build in _REGISTRY.items():
        if name not in WRITERS and available(ctx, name):
            build(ctx).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
    return names
