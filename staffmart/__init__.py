"""staffmart: a workforce-analytics mart (FTE, employment and sick-absence facts, year-to-date
mart, absence and FTE reports, quality checks, dashboard datasets, rolling stream) on Spark.

Entry points: ``plans.registry`` (named queries), ``plans.batch.run`` (publish the mart, write
every report), ``plans.views.register_views`` (temp views for SQL), ``python -m staffmart``.
"""

__version__ = "0.1.0"
