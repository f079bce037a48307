"""Hand-written personnel tables with one row per rule to prove (see FIXTURES.md).

Codes are the warehouse's own (default :class:`~staffmart.config.Exclusions`). Report end date
2016-02-29, so the report years are 2016 and 2015.
"""

from __future__ import annotations

import calendar
import datetime as dt
from decimal import Decimal as D

from staffmart.sources.schemas import SCHEMAS
from staffmart.sources.tables import Tables

TRAINEE = "Stagiair - zonder salaris"


def _df(spark, name, rows):
    return spark.createDataFrame(rows, SCHEMAS[name])


def fixture_tables(spark) -> Tables:
    months = [
        (y * 100 + m, y, m, calendar.monthrange(y, m)[1]) for y in (2014, 2015, 2016) for m in range(1, 13)
    ]
    functions = [
        (1, "F1", "Verpleegkundige"),
        (2, "3180000", "Uitgesloten"),
        (3, "dummy01", "Dummy"),
        (4, None, "Zonder code"),
    ]
    org = [
        (10, "KP1", "A1", "BC0001"),
        (11, "KP2", "A2", "BC0003"),   # excluded cluster
        (12, None, "A3", "BC0001"),    # no cost centre
        (13, "KP3", "A4", "BC0002"),   # cost centre without division row
        (14, "KP4", "A5", "BC0001"),   # division NULL
    ]
    contracts = [
        (100, "01", "01", "Werknemer", None),
        (101, "99", "01", "Werknemer", None),     # excluded employer
        (102, None, "01", "Werknemer", None),     # NULL employer: NOT IN drops it
        (103, "01", "15", "Werknemer", None),     # excluded relation
        (104, "01", None, "Werknemer", None),     # NULL relation: dropped
        (105, "01", "01", None, None),            # NULL worker type: kept
        (106, "01", "01", TRAINEE, None),         # trainee: dropped
    ]
    d = D
    actuals = [
        # medewerker, contract, function, org, days, group, month
        (1, 100, 1, 10, d("31"), "3", 201601),
        (1, 100, 1, 10, d("10"), "3", 201603),
        (1, 100, 1, 10, d("31"), "3", 201612),
        (1, 100, 2, 10, d("5"), "3", 201601),     # excluded function -> 'Onbekend'
        (1, 100, 1, 11, d("7"), "3", 201601),     # excluded cluster -> 'Onbekend'
        (None, 100, 1, 10, d("3"), "3", 201601),  # no employee -> 'Onbekend'
        (1, None, 1, 10, d("99"), "3", 201601),   # no contract -> dropped
        (1, 101, 1, 10, d("99"), "3", 201601),
        (1, 102, 1, 10, d("99"), "3", 201601),
        (1, 103, 1, 10, d("99"), "3", 201601),
        (1, 104, 1, 10, d("99"), "3", 201601),
        (1, 106, 1, 10, d("99"), "3", 201601),
        (2, 105, 1, 10, d("29"), "3", 201602),    # NULL worker type kept
        (2, 100, 1, 10, d("99"), "1", 201602),    # other group -> filtered
        (2, 100, 1, 10, d("99"), "3", 201401),    # two years back -> filtered
        (2, 100, 1, 13, d("31"), "3", 201601),    # cost centre without division
        (3, 100, 1, 14, d("31"), "3", 201601),    # division NULL
        (3, 100, 1, 10, d("30"), "3", 201511),    # previous year
    ]
    sick = [
        # medewerker, contract, function, org, sick days, pct, month
        (1, 100, 1, 10, d("2"), 0.1, 201601),
        (1, 100, 1, 10, d("1"), 0.0, 201601),     # pct 0 -> dropped
        (1, 100, 1, 10, d("1"), None, 201601),    # pct NULL -> dropped
        (1, 100, 1, 10, d("4"), 0.2, 201602),     # month without actuals -> zero days row
        (9, 100, 1, 10, d("5"), 0.1, 201601),     # employee not in dimension -> dropped
        (1, 100, 1, 12, d("3"), 0.1, 201601),     # NULL cost centre
        (1, 100, 1, 12, d("1"), 0.1, 201603),     # NULL cost centre again
        (1, 100, 2, 10, d("5"), 0.1, 201601),     # excluded function -> dropped
        (1, 100, 1, 11, d("5"), 0.1, 201601),     # excluded cluster -> dropped
        (1, 101, 1, 10, d("5"), 0.1, 201601),     # excluded employer -> dropped
        (1, 105, 1, 10, d("1"), 0.1, 201601),     # NULL worker type -> kept
    ]
    budget = [
        (201601, 1, 10, d("62"), "3"),
        (201601, 2, 10, d("9"), "3"),              # excluded function -> dropped
        (201601, 1, 11, d("9"), "3"),              # excluded cluster -> dropped
        (201601, 1, 10, d("9"), "1"),              # other group -> dropped
        (201401, 1, 10, d("9"), "3"),              # two years back -> dropped
    ]
    return Tables(
        ref_datum=_df(spark, "ref_datum", months),
        fact_fte_begroting=_df(spark, "fact_fte_begroting", budget),
        fact_fte_realisatie=_df(spark, "fact_fte_realisatie", actuals),
        fact_fte_ziekteverzuim=_df(spark, "fact_fte_ziekteverzuim", sick),
        dim_medewerker_functies=_df(spark, "dim_medewerker_functies", functions),
        dim_organisatie_eenheid=_df(spark, "dim_organisatie_eenheid", org),
        dim_dienstverbanden=_df(spark, "dim_dienstverbanden", contracts),
        dim_medewerkers=_df(spark, "dim_medewerkers", [(1,), (2,), (3,)]),
        dwh_budgetplaatsen=_df(spark, "dwh_budgetplaatsen", [("KP1", "DIV A"), ("KP4", None), ("KP2", "DIV B")]),
        dwh_rap_periode=_df(
            spark, "dwh_rap_periode", [("dwh_dashboard", dt.date(2016, 2, 29)), ("other", dt.date(2010, 1, 1))]
        ),
        afas_mdw_formatie=_df(spark, "afas_mdw_formatie", [(1, "01"), (2, "01"), (3, "07"), (4, None)]),
        afas_dienstbetrekking=_df(spark, "afas_dienstbetrekking", [("01", "Vast"), ("02", "Tijdelijk")]),
        afas_dienstperiodes=_df(
            spark,
            "afas_dienstperiodes",
            [(1, dt.date(2010, 3, 1), None), (1, dt.date(2012, 1, 1), "V1"), (2, dt.date(2015, 3, 1), "V2"),
             (3, dt.date(2015, 2, 28), None)],
        ),
    )
