"""Fixed values and job parameters.

Values under "fixed values" must equal the personnel warehouse's own codes and labels for
results to agree with it; everything else is a parameter with a default.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (from the warehouse load and its reports; keep verbatim)
# ---------------------------------------------------------------------------
UNKNOWN = "Onbekend"                      # unknown-member label for missing dimension rows
REPORT_PACKAGE = "dwh_dashboard"          # package_naam that owns the report period
BUDGET_GROUP = "3"                        # groepering_id used by budget and actuals
TOTAL_LABEL = "Hmc Totaal"                # grand-total label of the absence report
FTE_TOTAL_LABEL = " Mch Totaal"           # grand-total label of the FTE pivot (leading blank sorts first)
ROWPCT_TOTAL_LABEL = "Mch Totaal"         # grand-total label of the per-row absence reports
EXCLUDED_FUNCTIONS = ("3180000", "dummy01", "dummy02")
EXCLUDED_CLUSTERS = ("BC0003",)           # 'BUITEN EXPLOITATIE'
EXCLUDED_EMPLOYERS = ("99", "04", "13")
EXCLUDED_RELATIONS = ("15", "08", "14")
EXCLUDED_WORKER_TYPES = ("Stagiair - zonder salaris",)
MONTH_LABELS_ABSENCE = (
    "Verzuim Januari", "Verzuim Februari", "Verzuim Maart", "Verzuim April",
    "Verzuim Mei", "Verzuim Juni", "Verzuim Juli", "Verzuim Augustus",
    "Verzuim September", "Verzuim Oktober", "Verzuim November", "Verzuim December",
)
MONTH_LABELS_SHORT = ("Jan", "Feb", "Mar", "Apr", "Mei", "Jun", "Jul", "Aug", "Sep", "Okt", "Nov", "Dec")
FORMAT_THOUSANDS = "#,##0;-#,##0"
LOAD_OK = "Data geladen"                  # status texts of the load feed
LOAD_PROBLEM = "Probleem laden data"
# ---------------------------------------------------------------------------

# Output column names (snake_case for the bracketed names of the warehouse mart).
MART_KEYS = ("medewerker_id", "kostenplaats_code", "functie_code", "jaar")


@dataclass(frozen=True)
class Exclusions:
    """NOT IN lists applied to the dimensions (three-valued: NULL never passes a NOT IN)."""

    functions: tuple[str, ...] = EXCLUDED_FUNCTIONS
    clusters: tuple[str, ...] = EXCLUDED_CLUSTERS
    employers: tuple[str, ...] = EXCLUDED_EMPLOYERS
    relations: tuple[str, ...] = EXCLUDED_RELATIONS
    worker_types: tuple[str, ...] = EXCLUDED_WORKER_TYPES


@dataclass(frozen=True)
class ReportYears:
    """Current and previous report year (``@CUR_JAAR`` / ``@PRV_JAAR``)."""

    current: int
    previous: int

    @property
    def both(self) -> tuple[int, int]:
        return (self.previous, self.current)

    @property
    def first_month(self) -> int:
        return self.previous * 100 + 1

    @property
    def last_month(self) -> int:
        return self.current * 100 + 12


@dataclass(frozen=True)
class MartOptions:
    exclusions: Exclusions = field(default_factory=Exclusions)
    budget_group: str = BUDGET_GROUP
    include_budget: bool = False          # the budget insert is dormant in the warehouse load
