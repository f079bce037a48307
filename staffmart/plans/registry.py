"""Named queries: ``name -> (spark, sf_dir) -> DataFrame`` over the synthetic binding, or
``name -> Context -> DataFrame`` over any personnel tables (:func:`context_for`).

Each query opens the tables it reads, reads the report period if it needs it (one small job) and
returns an unevaluated DataFrame. The mart's jobs restrict the facts to the report years at the scan
(:attr:`Context.period`); all other queries see whole tables.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from staffmart.config import MartOptions, ReportYears
from staffmart.operators import mart as M
from staffmart.operators import quality as Q
from staffmart.operators import staging as S
from staffmart.plans import charts as G
from staffmart.plans import reports as R
from staffmart.plans import sinks
from staffmart.sources.binding import EXCLUSIONS, bind, read_raw
from staffmart.sources.loaders import inventory
from staffmart.sources.params import report_period
from staffmart.sources.tables import Tables
from staffmart.streaming.rolling import rolling_stream_result

# Division shown by the per-division control query (R2) in this binding.
CONTROL_DIVISION = "EUROPE"
# KPI filters of the dashboard lookups (R11) in this binding.
KPI_ITEM, KPI_CODE, KPI_SINCE_CODE, KPI_ITEM5 = "1-URGENT", "F", "O", "MGT_RAP"
KPI_SINCE_MONTHS = 3
# Length of the rolling per-user buffer (T1) and of the top-n lists.
ROLLING_N = 5
TOP_N = 8

OPTIONS = MartOptions(exclusions=EXCLUSIONS)


@dataclass(frozen=True)
class Context:
    """What a query reads. Tables are opened and the report period is read (one small job) when a
    query first asks for them."""

    tables: Tables
    sf_dir: str | None = None          # folder of the raw files (the stream reads it)
    event_table: Callable[[], DataFrame] | None = None   # events behind the time-series panels
    options: MartOptions = OPTIONS
    control_division: str = CONTROL_DIVISION
    kpi_item: str = KPI_ITEM
    kpi_code: str = KPI_CODE
    kpi_since_code: str = KPI_SINCE_CODE
    kpi_item5: str = KPI_ITEM5
    only_years: ReportYears | None = None   # in place of the report period's years

    _marts: dict = field(default_factory=dict, compare=False, repr=False)
    _report: list = field(default_factory=list, compare=False, repr=False)

    def _read_period(self) -> tuple[dt.date, ReportYears]:
        if not self._report:
            self._report.append(report_period(self.tables.dwh_rap_periode))
        return self._report[0]

    @property
    def end_date(self) -> dt.date:
        return self._read_period()[0]

    @property
    def years(self) -> ReportYears:
        return self.only_years or self._read_period()[1]

    @property
    def events(self) -> DataFrame | None:
        return self.event_table() if self.event_table else None

    @property
    def period(self) -> Tables:
        """The tables with the facts of the report years only."""
        return self.tables.for_periods(self.years.first_month, self.years.last_month)

    def mart(self, include_budget: bool = False) -> DataFrame:
        """The exact mart with YTD sums; built once per context (a lazy plan, not cached data)."""
        if include_budget not in self._marts:
            opts = dataclasses.replace(self.options, include_budget=include_budget)
            self._marts[include_budget] = M.fte_mart(self.period, self.years, opts)
        return self._marts[include_budget]


def context(spark: SparkSession, sf_dir: str) -> Context:
    """The synthetic binding. Nothing is kept between calls, so a long-lived session sees new files
    and parameters."""
    return Context(bind(spark, sf_dir), sf_dir, lambda: read_raw(spark, sf_dir, "events"))


def context_for(tables: Tables, options: MartOptions = MartOptions(), events: DataFrame | None = None,
                **report_params: str) -> Context:
    """A context over any personnel tables (e.g. from ``sources.loaders.SourceMap``); the
    default options carry the warehouse's own exclusion codes. ``report_params`` sets the
    control division and KPI filters (``control_division``, ``kpi_item``, ...)."""
    return Context(tables, None, (lambda: events) if events is not None else None, options, **report_params)


def _months_before(d: dt.date, months: int) -> int:
    y, m = divmod(d.year * 12 + d.month - 1 - months, 12)
    return y * 100 + m + 1


def report_month(end_date: dt.date) -> dt.date:
    """The reported month: the one holding the last day before the (exclusive) report end date."""
    return end_date - dt.timedelta(days=1)


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Callable[[Context], DataFrame]] = {}


def register(name: str):
    def deco(fn: Callable[[Context], DataFrame]):
        _REGISTRY[name] = fn
        return fn

    return deco


def queries() -> dict[str, Query]:
    return {name: (lambda spark, sf_dir, _fn=fn: _fn(context(spark, sf_dir))) for name, fn in _REGISTRY.items()}


# ----------------------------------------------------------------------------- staging + mart
# Decimal columns leave as doubles here: the comparison tools read decimals in different ways.
register("budget_fte")(lambda c: S.budget_fte(c.period, c.years, c.options))
register("actual_fte")(lambda c: S.actual_fte(c.period, c.years, c.options))
register("actual_fte_by_function")(lambda c: S.actual_fte_by_function(c.period, c.years, c.options))
register("sick_days")(lambda c: S.sick_days(c.period, c.years, c.options))
register("fte_mart")(lambda c: M.as_doubles(M.fte_mart_plain(c.period, c.years, c.options)))
register("fte_mart_ytd")(lambda c: M.as_doubles(M.display(c.mart())))
register("budget_vs_actual")(lambda c: M.as_doubles(M.display(c.mart(include_budget=True))))

# ----------------------------------------------------------------------------- reports
register("control_total")(lambda c: R.control_total(c.mart()))
register("control_division")(
    lambda c: M.as_doubles(R.control_division(c.mart(), c.tables.dwh_budgetplaatsen, c.years, c.control_division))
)
register("absence_monthly")(lambda c: R.absence_monthly(c.mart(), c.tables.dwh_budgetplaatsen))
register("absence_pivot")(
    lambda c: M.as_doubles(R.absence_pivot(c.mart(), c.tables.dwh_budgetplaatsen, c.years))
)
register("fte_pivot")(lambda c: M.as_doubles(R.fte_pivot(c.mart(), c.tables.dwh_budgetplaatsen, c.years.current)))
register("fte_pivot_with_total")(
    lambda c: M.as_doubles(R.fte_pivot_with_total(c.mart(), c.tables.dwh_budgetplaatsen, c.years.current))
)
register("absence_rowpct_pivot")(
    lambda c: M.as_doubles(R.absence_rowpct_pivot(c.mart(), c.tables.dwh_budgetplaatsen, c.years.current))
)
register("absence_rowpct_total")(lambda c: M.as_doubles(R.absence_rowpct_total(c.mart(), c.years.current)))
register("absence_total_pivot")(lambda c: M.as_doubles(R.absence_total_pivot(c.mart(), c.years.current)))
register("absence_year_total")(lambda c: R.absence_year_total(c.mart(), c.years.current))
register("fte_mart_ytd_selfjoin")(lambda c: M.as_doubles(M.display(M.ytd_by_self_join(M.mart_totals(c.period, c.years, c.options)))))
register("kpi_lookup")(
    lambda c: R.kpi_lookup(c.tables.dwh_dashboard, report_month(c.end_date).strftime("%Y%m"), c.kpi_item, c.kpi_code)
)
register("kpi_since")(
    lambda c: R.kpi_since(c.tables.dwh_dashboard, c.kpi_since_code,
                          _months_before(report_month(c.end_date), KPI_SINCE_MONTHS), c.kpi_item5)
)
register("relation_counts_formatie")(lambda c: R.relation_counts(c.tables.afas_mdw_formatie, c.tables.afas_dienstbetrekking))
register("relation_counts_contracts")(
    lambda c: R.relation_counts(c.tables.dim_dienstverbanden, c.tables.afas_dienstbetrekking)
)
register("relation_enrich")(lambda c: R.relation_enrich(c.tables.dim_dienstverbanden, c.tables.afas_dienstbetrekking))
register("leave_reasons")(lambda c: R.leave_reasons(c.tables.afas_dienstperiodes))

# ----------------------------------------------------------------------------- data quality
# the contract dimension as it is, and as a second load of part of it would leave it
register("duplicate_load_contracts")(
    lambda c: Q.duplicate_load(c.tables.dim_dienstverbanden, "dim_dienstverbanden").unionByName(
        Q.duplicate_load(c.tables.dim_dienstverbanden.unionByName(c.tables.dim_dienstverbanden.where("werkgever_code = '5-LOW'")),
                         "dim_dienstverbanden dubbel geladen"))
)
# a load against itself, against a table that took it twice, and against one with rows of its own
register("repeated_loads")(
    lambda c: Q.times_loaded(c.tables.dim_dienstverbanden, c.tables.dim_dienstverbanden, "eenmaal")
    .unionByName(Q.times_loaded(c.tables.dim_dienstverbanden.unionByName(c.tables.dim_dienstverbanden), c.tables.dim_dienstverbanden, "tweemaal"))
    .unionByName(Q.times_loaded(c.tables.dim_dienstverbanden.unionByName(c.tables.dim_dienstverbanden.where("werkgever_code = '5-LOW'")),
                                c.tables.dim_dienstverbanden, "gedeeltelijk"))
)
register("dimension_key_counts")(
    lambda c: Q.key_counts(c.tables.ref_datum, "ref_datum", "maand_id")
    .unionByName(Q.key_counts(c.tables.dim_medewerker_functies, "dim_medewerker_functies", "medewerker_functie_id"))
    .unionByName(Q.key_counts(c.tables.dim_organisatie_eenheid, "dim_organisatie_eenheid", "organisatie_eenheid_id"))
    .unionByName(Q.key_counts(c.tables.dim_dienstverbanden, "dim_dienstverbanden", "dienstverband_id"))
    .unionByName(Q.key_counts(c.tables.fact_fte_realisatie, "fact_fte_realisatie", "dienstverband_id"))
)
register("dimension_key_duplicates")(
    lambda c: Q.key_duplicates(c.tables.ref_datum, "ref_datum", "maand_id")
    .unionByName(Q.key_duplicates(c.tables.dim_medewerker_functies, "dim_medewerker_functies", "medewerker_functie_id"))
    .unionByName(Q.key_duplicates(c.tables.dim_organisatie_eenheid, "dim_organisatie_eenheid", "organisatie_eenheid_id"))
    .unionByName(Q.key_duplicates(c.tables.dim_dienstverbanden, "dim_dienstverbanden", "dienstverband_id"))
    .unionByName(Q.key_duplicates(c.tables.dim_medewerkers, "dim_medewerkers", "medewerker_id"))
    .unionByName(Q.key_duplicates(c.tables.dwh_budgetplaatsen, "dwh_budgetplaatsen", "kostenplaats_code"))
    .unionByName(Q.key_duplicates(c.tables.afas_dienstbetrekking, "afas_dienstbetrekking", "tabelwaarde_code"))
)
register("mart_reconciliation")(
    lambda c: Q.reconciliation(c.period, c.years, c.options, c.mart())
)
register("zero_denominators")(lambda c: Q.zero_denominators(c.tables.ref_datum, c.mart()))
register("unknown_member_rate")(
    lambda c: Q.unknown_member_rate(S.actual_rows(c.period, c.years, c.options),
                                    ["medewerker_id", "kostenplaats_code", "functiecode"])
)
register("unmatched_relations")(
    lambda c: Q.unmatched(c.tables.dim_dienstverbanden, c.tables.afas_dienstbetrekking, "dienstbetrekking", "tabelwaarde_code")
)
register("unmatched_cost_centres")(
    lambda c: Q.unmatched(c.mart(), c.tables.dwh_budgetplaatsen, "kostenplaats_code", "kostenplaats_code")
)

# ----------------------------------------------------------------------------- chart datasets
register("quarterly_series")(lambda c: G.quarterly_series(c.mart()))
register("sick_days_by_division")(lambda c: G.sick_days_by_division(c.mart(), c.tables.dwh_budgetplaatsen))
register("sick_share_by_division")(lambda c: G.sick_share_by_division(c.mart(), c.tables.dwh_budgetplaatsen))
register("budget_vs_actual_by_year")(lambda c: G.budget_vs_actual_by_year(c.mart(include_budget=True)))
register("days_by_year")(lambda c: G.days_by_year(c.mart()))
register("daily_two_series")(lambda c: G.daily_two_series(c.events))
register("two_series")(lambda c: G.two_series(c.events))
register("daily_bars")(lambda c: G.daily_bars(c.events))
register("latest_rows")(lambda c: G.latest_rows(c.events, TOP_N))
register("load_feed")(lambda c: G.load_feed(c.events, TOP_N))
register("absence_current_year")(
    lambda c: G.absence_current_year(R.absence_monthly(c.mart(), c.tables.dwh_budgetplaatsen), c.years.current)
)
register("absence_by_year")(lambda c: G.absence_by_year(c.mart()))
register("absence_by_function")(lambda c: G.absence_by_function(c.mart()))
register("contracts_by_relation")(
    lambda c: G.contracts_by_relation(c.tables.fact_fte_realisatie, c.tables.dim_dienstverbanden)
)
register("service_years")(lambda c: G.service_years(c.tables.afas_dienstperiodes, c.end_date))
register("service_years_by_year")(
    lambda c: G.service_years_by_year(c.tables.afas_dienstperiodes, c.end_date)
)

# ----------------------------------------------------------------------------- streaming + catalogue
register("rolling_buffer")(lambda c: G.rolling_buffer(c.events, ROLLING_N).drop("ts"))

# queries that need the event table (and, for the stream, its folder)
EVENT_QUERIES = frozenset(
    {"daily_two_series", "two_series", "daily_bars", "latest_rows", "load_feed", "rolling_buffer", "rolling_buffer_stream"}
)
# queries that need optional personnel tables
NEEDS = {
    "kpi_lookup": ("dwh_dashboard",),
    "kpi_since": ("dwh_dashboard",),
    "relation_counts_formatie": ("afas_mdw_formatie", "afas_dienstbetrekking"),
    "relation_counts_contracts": ("afas_dienstbetrekking",),
    "relation_enrich": ("afas_dienstbetrekking",),
    "dimension_key_duplicates": ("afas_dienstbetrekking",),
    "unmatched_relations": ("afas_dienstbetrekking",),
    "leave_reasons": ("afas_dienstperiodes",),
    "service_years": ("afas_dienstperiodes",),
    "service_years_by_year": ("afas_dienstperiodes",),
}


# queries over the mart with budget rows
BUDGET_QUERIES = frozenset({"budget_vs_actual", "budget_vs_actual_by_year"})
# queries that run a job of their own when they are built: the stream, and sinks read back
WRITERS = frozenset({"rolling_buffer_stream", "published_mart", "refreshed_mart", "appended_contracts", "truncated_contracts", "updated_contracts",
                     "appended_mart", "observed_checks", "contracts_by_relation_kept", "actual_fte_bucketed", "sick_days_bucketed", "seasonal_days", "stored_inventory"})


def available(c: Context, name: str) -> bool:
    """Whether the context has every input the query reads."""
    if name in EVENT_QUERIES and c.event_table is None:
        return False
    return all(c.tables.has(t) for t in NEEDS.get(name, ()))
register("rolling_buffer_stream")(
    lambda c: rolling_stream_result(c.events.sparkSession, c.sf_dir, ROLLING_N, file_glob="events.parquet")
)
register("catalogue_inventory")(lambda c: inventory(c.tables.views()))

# ----------------------------------------------------------------------------- sinks, read back
register("published_mart")(lambda c: sinks.published_mart(c))
register("refreshed_mart")(lambda c: sinks.refreshed_mart(c))
register("appended_contracts")(lambda c: sinks.appended_contracts(c))
register("truncated_contracts")(lambda c: sinks.truncated_contracts(c))
register("updated_contracts")(lambda c: sinks.updated_contracts(c))
for _sink in (sinks.appended_mart, sinks.observed_checks, sinks.contracts_by_relation_kept, sinks.actual_fte_bucketed, sinks.sick_days_bucketed,
              sinks.seasonal_days, sinks.stored_inventory):
    register(_sink.__name__)(_sink)
