"""Reference SQL for every registered query, written for DuckDB over the raw synthetic tables.

The binding of :mod:`staffmart.sources.binding` is restated as SQL CTEs, then each job is
written the way the warehouse wrote it (joins, conditional aggregation, triangular self-join
for the running sums), independently of the Spark code. Measures follow the same exact-decimal
rules, so results agree value for value.
"""

from __future__ import annotations

from staffmart.config import FTE_TOTAL_LABEL, LOAD_OK, LOAD_PROBLEM, ROWPCT_TOTAL_LABEL, TOTAL_LABEL
from staffmart.operators.quality import REASONS_DAYS, REASONS_SICK
from staffmart.plans.reports import ABSENCE_COLUMNS, FTE_COLUMNS
from staffmart.plans.registry import (
    CONTROL_DIVISION,
    KPI_CODE,
    KPI_ITEM,
    KPI_ITEM5,
    KPI_SINCE_CODE,
    KPI_SINCE_MONTHS,
    ROLLING_N,
)

BINDING = f"""
params AS (
  SELECT CAST(year(max(o_orderdate)) AS INTEGER) AS cur,
         CAST(year(max(o_orderdate) - INTERVAL 1 YEAR) AS INTEGER) AS prv,
         CAST(max(o_orderdate) AS DATE) AS einddatum
  FROM orders
),
bounds AS (
  SELECT make_date(CAST(year(min(o_orderdate)) AS INTEGER), 1, 1) AS lo,
         make_date(CAST(year(max(o_orderdate)) AS INTEGER), 12, 1) AS hi
  FROM orders
),
ref_datum AS (
  SELECT CAST(year(m) * 100 + month(m) AS INTEGER) AS maand_id,
         CAST(year(m) AS INTEGER) AS jaar,
         CAST(month(m) AS INTEGER) AS maandnummer,
         CAST(day(last_day(m)) AS INTEGER) AS aantal_dagen_maand
  FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m FROM bounds)
),
fact_fte_realisatie AS (
  SELECT CASE WHEN l_tax <> 0 THEN l_suppkey END AS medewerker_id,
         l_orderkey AS dienstverband_id, l_partkey AS medewerker_functie_id,
         l_suppkey AS organisatie_eenheid_id,
         CAST(l_quantity AS DECIMAL(18,6)) AS dienstverband_dagen,
         CASE WHEN l_linestatus = 'F' THEN '3' ELSE '1' END AS groepering_id,
         CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS maand_id
  FROM lineitem
),
fact_fte_ziekteverzuim AS (
  SELECT l_suppkey AS medewerker_id, l_orderkey AS dienstverband_id, l_partkey AS medewerker_functie_id,
         l_suppkey AS organisatie_eenheid_id,
         CAST(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS DECIMAL(18,6))
           AS dagen_ziek_ex_zwanger,
         l_discount AS ziektepercentage,
         CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS maand_id
  FROM lineitem WHERE l_returnflag = 'R'
),
fact_fte_begroting AS (
  SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS maand_id,
         l_partkey AS medewerker_functie_id, l_suppkey AS organisatie_eenheid_id,
         CAST(l_quantity AS DECIMAL(18,6)) AS fte_begroot_dagen,
         CASE WHEN l_linestatus = 'F' THEN '3' ELSE '1' END AS groepering_id
  FROM lineitem WHERE l_returnflag = 'N'
),
dim_medewerker_functies AS (
  SELECT p_partkey AS medewerker_functie_id, p_type AS medewerker_functie_code,
         'Functie ' || p_type AS medewerker_functie_naam
  FROM part
),
dim_organisatie_eenheid AS (
  SELECT s_suppkey AS organisatie_eenheid_id, n_name AS kostenplaats_code, n_name AS afdeling_code,
         r_name AS cluster_code
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
dim_dienstverbanden AS (
  SELECT o_orderkey AS dienstverband_id, o_orderpriority AS werkgever_code, o_orderstatus AS dienstbetrekking,
         CASE WHEN day(o_orderdate) = 31 THEN NULL
              WHEN day(o_orderdate) <= 2 THEN 'Stagiair - zonder salaris'
              ELSE 'Werknemer' END AS type_werknemer,
         CASE WHEN day(o_orderdate) = 7 THEN 'Oude omschrijving' END AS dienstbetrekking_oms
  FROM orders
),
dim_medewerkers AS (SELECT s_suppkey AS medewerker_id FROM supplier),
dwh_rap_periode AS (SELECT 'dwh_dashboard' AS package_naam, einddatum AS rapport_einddatum FROM params),
dwh_budgetplaatsen AS (
  SELECT n_name AS kostenplaats_code, CASE WHEN r_name <> 'MIDDLE EAST' THEN r_name END AS zorgbedrijf
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
dwh_dashboard AS (
  SELECT strftime(o_orderdate, '%Y%m') AS rap_periode, o_orderpriority AS rap_item, o_orderstatus AS rap_code,
         count(*) AS rap_waarde,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'MGT_RAP' ELSE 'AFD_RAP' END AS rap_item5
  FROM orders GROUP BY 1, 2, 3, 5
),
afas_mdw_formatie AS (SELECT o_custkey AS medewerker_id, o_orderstatus AS dienstbetrekking FROM orders),
afas_dienstperiodes AS (
  SELECT o_custkey AS medewerker_id, CAST(o_orderdate AS DATE) AS datum_in,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS reden_uit_dienst_code
  FROM orders
),
events_d AS (SELECT *, CAST(ts AS DATE) AS dag FROM events),
afas_dienstbetrekking AS (
  SELECT * FROM (VALUES ('F', 'Vast dienstverband'), ('O', 'Oproepcontract'), ('O', 'Oproep (oud)')) AS t(tabelwaarde_code, omschrijving)
),
fn_kept AS (
  SELECT medewerker_functie_id, medewerker_functie_code, medewerker_functie_naam
  FROM dim_medewerker_functies WHERE medewerker_functie_code NOT IN ('PROMO')
),
org_kept AS (
  SELECT organisatie_eenheid_id, kostenplaats_code, afdeling_code
  FROM dim_organisatie_eenheid WHERE cluster_code NOT IN ('AFRICA')
),
con_kept AS (
  SELECT dienstverband_id FROM dim_dienstverbanden
  WHERE werkgever_code NOT IN ('5-LOW') AND dienstbetrekking NOT IN ('P')
    AND coalesce(type_werknemer, '') NOT IN ('Stagiair - zonder salaris')
)"""

YEARS = "(f.maand_id BETWEEN p.prv * 100 + 1 AND p.prv * 100 + 12 OR f.maand_id BETWEEN p.cur * 100 + 1 AND p.cur * 100 + 12)"


def _fte(days: str, length: str = "aantal_dagen_maand") -> str:
    """days / days in the month as decimal(18,8), half up, by whole-number division."""
    return (f"CASE WHEN {length} > 0 THEN CAST(CAST((2 * CAST({days} * 1000000 AS HUGEINT) * 100 + {length}) // (2 * {length}) AS DECIMAL(18,0))"
            f" * CAST(0.00000001 AS DECIMAL(9,8)) AS DECIMAL(18,8)) END")


def _avg(total: str, month: str = "CAST(maand AS INTEGER)") -> str:
    """A year-to-date sum over the month number as decimal(18,8), half up."""
    return (f"CAST(CAST((2 * CAST({total} * 100000000 AS HUGEINT) + {month}) // (2 * {month}) AS DECIMAL(18,0))"
            f" * CAST(0.00000001 AS DECIMAL(9,8)) AS DECIMAL(18,8))")

STAGING = f""",
actual_rows AS (
  SELECT coalesce(CAST(f.medewerker_id AS VARCHAR), 'Onbekend') AS medewerker_id,
         coalesce(CAST(f.dienstverband_id AS VARCHAR), 'Onbekend') AS dienstverband_id,
         coalesce(o.kostenplaats_code, 'Onbekend') AS kostenplaats_code,
         coalesce(o.afdeling_code, 'Onbekend') AS afdeling_code,
         coalesce(fn.medewerker_functie_code, 'Onbekend') AS functiecode,
         coalesce(fn.medewerker_functie_naam, 'Onbekend') AS oms_functie,
         coalesce(CAST(c.jaar AS VARCHAR), 'Onbekend') AS jaar,
         coalesce(CAST(c.maandnummer AS VARCHAR), 'Onbekend') AS maandnummer,
         f.maand_id AS periode,
         c.aantal_dagen_maand,
         coalesce(f.dienstverband_dagen, 0) AS dienstverband_dagen
  FROM fact_fte_realisatie f
  JOIN ref_datum c ON f.maand_id = c.maand_id
  LEFT JOIN fn_kept fn ON f.medewerker_functie_id = fn.medewerker_functie_id
  LEFT JOIN org_kept o ON f.organisatie_eenheid_id = o.organisatie_eenheid_id
  JOIN con_kept k ON f.dienstverband_id = k.dienstverband_id
  CROSS JOIN params p
  WHERE f.groepering_id = '3' AND {YEARS}
),
sick_rows AS (
  SELECT CAST(c.jaar AS VARCHAR) || lpad(CAST(c.maandnummer AS VARCHAR), 2, '0') AS periode,
         o.kostenplaats_code, fn.medewerker_functie_code AS functiecode,
         CAST(e.medewerker_id AS VARCHAR) AS medewerker_id,
         c.aantal_dagen_maand,
         coalesce(f.dagen_ziek_ex_zwanger, 0) AS dagen_ziek_ex_zwanger
  FROM fact_fte_ziekteverzuim f
  JOIN ref_datum c ON f.maand_id = c.maand_id
  JOIN fn_kept fn ON f.medewerker_functie_id = fn.medewerker_functie_id
  JOIN org_kept o ON f.organisatie_eenheid_id = o.organisatie_eenheid_id
  JOIN dim_medewerkers e ON f.medewerker_id = e.medewerker_id
  JOIN con_kept k ON f.dienstverband_id = k.dienstverband_id
  CROSS JOIN params p
  WHERE {YEARS} AND f.ziektepercentage <> 0
),
budget_rows AS (
  SELECT o.kostenplaats_code, o.afdeling_code, fn.medewerker_functie_code, fn.medewerker_functie_naam,
         c.jaar, c.maandnummer, f.maand_id,
         c.aantal_dagen_maand, coalesce(f.fte_begroot_dagen, 0) AS begroot_dagen
  FROM fact_fte_begroting f
  JOIN ref_datum c ON f.maand_id = c.maand_id
  JOIN fn_kept fn ON f.medewerker_functie_id = fn.medewerker_functie_id
  JOIN org_kept o ON f.organisatie_eenheid_id = o.organisatie_eenheid_id
  CROSS JOIN params p
  WHERE f.groepering_id = '3' AND c.jaar IN (p.prv, p.cur) AND {YEARS}
)"""


def _mart(include_budget: bool = False) -> str:
    budget = ""
    if include_budget:
        budget = """
  UNION ALL
  SELECT CAST(maand_id AS VARCHAR), 'Onbekend', kostenplaats_code, medewerker_functie_code, aantal_dagen_maand, begroot_dagen, 0, 0
  FROM budget_rows"""
    same = "a.medewerker_id = b.medewerker_id AND a.kostenplaats_code = b.kostenplaats_code AND a.functie_code = b.functie_code AND a.jaar = b.jaar"
    return f""",
stacked AS (
  SELECT CAST(periode AS VARCHAR) AS periode, medewerker_id, kostenplaats_code, functiecode AS functie_code,
         aantal_dagen_maand, CAST(0 AS DECIMAL(18,6)) AS begroot_dagen, CAST(0 AS DECIMAL(18,6)) AS dagen_ziek_ex_zwanger, dienstverband_dagen
  FROM actual_rows
  UNION ALL
  SELECT periode, medewerker_id, kostenplaats_code, functiecode, aantal_dagen_maand, 0, dagen_ziek_ex_zwanger, 0
  FROM sick_rows{budget}
),
mart_totals AS (
  SELECT substr(periode, 1, 4) AS jaar, right(periode, 2) AS maand, medewerker_id, kostenplaats_code, functie_code,
         {_fte('sum(begroot_dagen)', 'max(aantal_dagen_maand)')} AS fte_begroot,
         {_fte('sum(dienstverband_dagen)', 'max(aantal_dagen_maand)')} AS fte_realisatie,
         sum(dagen_ziek_ex_zwanger) AS dagen_ziek_ex_zwanger, sum(dienstverband_dagen) AS dienstverband_dagen
  FROM stacked
  GROUP BY 1, 2, 3, 4, 5
),
ytd AS (
  SELECT a.medewerker_id, a.kostenplaats_code, a.functie_code, a.jaar, a.maand,
         sum(b.fte_realisatie) AS fte_realisatie_ytd, sum(b.dagen_ziek_ex_zwanger) AS dagen_ziek_ex_zwanger_ytd,
         sum(b.dienstverband_dagen) AS dienstverband_dagen_ytd
  FROM mart_totals a JOIN mart_totals b ON {same} AND a.maand >= b.maand
  GROUP BY 1, 2, 3, 4, 5
),
mart AS (
  SELECT m.*,
         CASE WHEN m.medewerker_id IS NOT NULL AND m.kostenplaats_code IS NOT NULL AND m.functie_code IS NOT NULL AND m.jaar IS NOT NULL
              THEN y.fte_realisatie_ytd ELSE m.fte_realisatie END AS fte_realisatie_ytd,
         coalesce(y.dagen_ziek_ex_zwanger_ytd, 0) AS dagen_ziek_ex_zwanger_ytd,
         coalesce(y.dienstverband_dagen_ytd, 0) AS dienstverband_dagen_ytd
  FROM mart_totals m
  LEFT JOIN ytd y ON m.medewerker_id = y.medewerker_id AND m.kostenplaats_code = y.kostenplaats_code
    AND m.functie_code = y.functie_code AND m.jaar = y.jaar AND m.maand = y.maand
)"""


def _with(*parts: str) -> str:
    return "WITH " + BINDING + "".join(parts)


def _dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def _cents(num: str, den: str) -> str:
    """100 * num / den to hundredths, half up, as a decimal(18,2) read as a double."""
    n, d = f"CAST({num} * 1000000 AS HUGEINT)", f"CAST({den} * 1000000 AS HUGEINT)"
    return f"CAST(CASE WHEN {d} > 0 THEN sign({n}) * ((abs({n}) * 20000 + {d}) // (2 * {d})) END AS DOUBLE) / 100.0"


def _percent_text(num: str, den: str) -> str:
    """100 * num / den to hundredths, half up in whole numbers, as text with two decimals."""
    n, d = f"CAST({num} * 1000000 AS HUGEINT)", f"CAST({den} * 1000000 AS HUGEINT)"
    cents = f"((abs({n}) * 20000 + {d}) // (2 * {d}))"
    return (f"CASE WHEN {d} > 0 THEN CASE WHEN {n} < 0 AND {cents} > 0 THEN '-' ELSE '' END || CAST({cents} // 100 AS VARCHAR) || '.' || "
            f"lpad(CAST({cents} % 100 AS VARCHAR), 2, '0') END")


def _pct(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100.0"


def _thousands(expr: str) -> str:
    return f"format('{{:,}}', CAST(round({expr}, 0) AS BIGINT))"


MART_DISPLAY = f"""
SELECT jaar, maand, medewerker_id, kostenplaats_code, functie_code,
       {_dbl('fte_begroot')} AS fte_begroot,
       {_dbl('fte_realisatie')} AS fte_realisatie,
       {_dbl(_avg('fte_realisatie_ytd'))} AS fte_realisatie_cum,
       {_dbl('dagen_ziek_ex_zwanger')} AS dagen_ziek_ex_zwanger,
       {_dbl('dienstverband_dagen')} AS dienstverband_dagen,
       {_dbl(_avg('dagen_ziek_ex_zwanger_ytd'))} AS dagen_ziek_ex_zwanger_cum,
       {_dbl(_avg('dienstverband_dagen_ytd'))} AS dienstverband_dagen_cum
FROM mart"""

MONTHLY = f""",
cc AS (
  SELECT kostenplaats_code, jaar, maand,
         sum(dagen_ziek_ex_zwanger) AS z, sum(dienstverband_dagen) AS d,
         sum(dagen_ziek_ex_zwanger_ytd) AS zc, sum(dienstverband_dagen_ytd) AS dc
  FROM mart GROUP BY 1, 2, 3
),
monthly AS (
  SELECT '{TOTAL_LABEL}' AS divisie, jaar, maand, {_pct('sum(z)', 'sum(d)')} AS zv, {_pct('sum(zc)', 'sum(dc)')} AS zvc,
         {_cents('sum(z)', 'sum(d)')} AS zv2, {_cents('sum(zc)', 'sum(dc)')} AS zvc2
  FROM cc GROUP BY jaar, maand
  UNION ALL
  SELECT b.zorgbedrijf, cc.jaar, cc.maand, {_pct('sum(z)', 'sum(d)')}, {_pct('sum(zc)', 'sum(dc)')},
         {_cents('sum(z)', 'sum(d)')}, {_cents('sum(zc)', 'sum(dc)')}
  FROM cc JOIN dwh_budgetplaatsen b ON cc.kostenplaats_code = b.kostenplaats_code
  GROUP BY b.zorgbedrijf, cc.jaar, cc.maand
)"""


def _month_cols(value: str, names, agg: str, default: str | None) -> str:
    out = []
    for m, name in enumerate(names, start=1):
        els = f" ELSE {default}" if default is not None else ""
        out.append(f"{agg}(CASE WHEN CAST(maand AS INTEGER) = {m} THEN {value}{els} END) AS {name}")
    return ",\n       ".join(out)


def _fte_pivot_rows(with_total: bool) -> str:
    total = ""
    if with_total:
        total = f"""
  UNION ALL
  SELECT '{FTE_TOTAL_LABEL}', jaar, maand, sum(u) FROM dm GROUP BY jaar, maand"""
    return f""",
dm AS (
  SELECT b.zorgbedrijf, m.jaar, m.maand, sum(m.fte_realisatie) AS u
  FROM mart m JOIN dwh_budgetplaatsen b ON m.kostenplaats_code = b.kostenplaats_code, params p
  WHERE b.zorgbedrijf IS NOT NULL AND m.jaar = CAST(p.cur AS VARCHAR)
  GROUP BY 1, 2, 3
),
rows_ AS (SELECT zorgbedrijf, jaar, maand, u FROM dm{total})
SELECT zorgbedrijf, jaar,
       {", ".join(f"coalesce(CAST(CAST(sum(CASE WHEN CAST(maand AS INTEGER) = {m} THEN u END) AS DECIMAL(18,2)) AS DOUBLE), 0.0) AS {n}" for m, n in enumerate(FTE_COLUMNS, start=1))}
FROM rows_ GROUP BY zorgbedrijf, jaar"""


# exact half-up rounding of 100 * a / b to hundredths, in integers
ROW_CENTS = """CASE WHEN CAST(dienstverband_dagen * 1000000 AS BIGINT) > 0 THEN
  sign(CAST(dagen_ziek_ex_zwanger * 1000000 AS BIGINT)) *
  ((2 * abs(CAST(dagen_ziek_ex_zwanger * 1000000 AS BIGINT)) * 10000 + CAST(dienstverband_dagen * 1000000 AS BIGINT))
   // (2 * CAST(dienstverband_dagen * 1000000 AS BIGINT))) END"""


# table: columns as name type length
_COLUMNS = """
ref_datum: maand_id int 4, jaar int 4, maandnummer int 4, aantal_dagen_maand int 4
fact_fte_begroting: maand_id int 4, medewerker_functie_id bigint 8, organisatie_eenheid_id bigint 8, fte_begroot_dagen decimal(18;6) 16, groepering_id string -
fact_fte_realisatie: medewerker_id bigint 8, dienstverband_id bigint 8, medewerker_functie_id bigint 8, organisatie_eenheid_id bigint 8, dienstverband_dagen decimal(18;6) 16, groepering_id string -, maand_id int 4
fact_fte_ziekteverzuim: medewerker_id bigint 8, dienstverband_id bigint 8, medewerker_functie_id bigint 8, organisatie_eenheid_id bigint 8, dagen_ziek_ex_zwanger decimal(18;6) 16, ziektepercentage double 8, maand_id int 4
dim_medewerker_functies: medewerker_functie_id bigint 8, medewerker_functie_code string -, medewerker_functie_naam string -
dim_organisatie_eenheid: organisatie_eenheid_id bigint 8, kostenplaats_code string -, afdeling_code string -, cluster_code string -
dim_dienstverbanden: dienstverband_id bigint 8, werkgever_code string -, dienstbetrekking string -, type_werknemer string -, dienstbetrekking_oms string -
dim_medewerkers: medewerker_id bigint 8
dwh_budgetplaatsen: kostenplaats_code string -, zorgbedrijf string -
dwh_rap_periode: package_naam string -, rapport_einddatum date 4
dwh_dashboard: rap_periode string -, rap_item string -, rap_code string -, rap_waarde bigint 8, rap_item5 string -
afas_mdw_formatie: medewerker_id bigint 8, dienstbetrekking string -
afas_dienstbetrekking: tabelwaarde_code string -, omschrijving string -
afas_dienstperiodes: medewerker_id bigint 8, datum_in date 4, reden_uit_dienst_code string -
"""
CATALOGUE = [
    (line.split(":")[0], name, kind.replace(";", ","), -1 if n == "-" else int(n))
    for line in _COLUMNS.strip().splitlines() for name, kind, n in (c.split() for c in line.split(":")[1].split(", "))
]


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["budget_fte"] = _with(STAGING) + f"""
SELECT kostenplaats_code, afdeling_code, medewerker_functie_code AS functiecode_excl,
       medewerker_functie_code AS functiecode, medewerker_functie_naam AS oms_functie,
       {_dbl(_fte('sum(begroot_dagen)', 'max(aantal_dagen_maand)'))} AS formatie, CAST(0 AS DOUBLE) AS gem_realisatie_cum, jaar, maandnummer, maand_id AS periode
FROM budget_rows
GROUP BY kostenplaats_code, afdeling_code, medewerker_functie_code, medewerker_functie_naam, jaar, maandnummer, maand_id"""
    q["actual_fte"] = _with(STAGING) + f"""
SELECT medewerker_id, dienstverband_id, kostenplaats_code, afdeling_code, functiecode AS functiecode_excl,
       functiecode, oms_functie, CAST(0 AS DOUBLE) AS plan_formatie, {_dbl(_fte('sum(dienstverband_dagen)', 'max(aantal_dagen_maand)'))} AS realisatie,
       {_dbl('sum(dienstverband_dagen)')} AS dienstverband_dagen, CAST(0 AS DOUBLE) AS gem_realisatie, jaar, maandnummer, periode
FROM actual_rows
GROUP BY medewerker_id, dienstverband_id, kostenplaats_code, afdeling_code, functiecode, oms_functie, jaar, maandnummer, periode"""
    q["actual_fte_by_function"] = _with(STAGING) + f"""
SELECT periode, medewerker_id, kostenplaats_code, functiecode AS functie_code, CAST(0 AS DOUBLE) AS formatie,
       {_dbl(_fte('sum(dienstverband_dagen)', 'max(aantal_dagen_maand)'))} AS realisatie, CAST(0 AS DOUBLE) AS dagen_ziek_ex_zwanger,
       {_dbl('sum(dienstverband_dagen)')} AS dienstverband_dagen
FROM actual_rows GROUP BY periode, medewerker_id, kostenplaats_code, functiecode"""
    q["sick_days"] = _with(STAGING) + f"""
SELECT periode, kostenplaats_code, functiecode, medewerker_id, {_dbl('sum(dagen_ziek_ex_zwanger)')} AS dagen_ziek_ex_zwanger
FROM sick_rows GROUP BY periode, kostenplaats_code, functiecode, medewerker_id"""
    q["fte_mart"] = _with(STAGING, _mart()) + f"""
SELECT jaar, maand, medewerker_id, kostenplaats_code, functie_code,
       {_dbl('fte_begroot')} AS fte_begroot, {_dbl('fte_realisatie')} AS fte_realisatie,
       {_dbl('fte_realisatie')} AS fte_realisatie_cum, {_dbl('dagen_ziek_ex_zwanger')} AS dagen_ziek_ex_zwanger,
       {_dbl('dienstverband_dagen')} AS dienstverband_dagen, CAST(0 AS DOUBLE) AS dagen_ziek_ex_zwanger_cum,
       CAST(0 AS DOUBLE) AS dienstverband_dagen_cum
FROM mart_totals"""
    q["fte_mart_ytd"] = _with(STAGING, _mart()) + MART_DISPLAY
    q["budget_vs_actual"] = _with(STAGING, _mart(include_budget=True)) + MART_DISPLAY
    q["control_total"] = _with(STAGING, _mart()) + f"""
SELECT '{TOTAL_LABEL}' AS divisie, jaar,
       {_thousands('sum(dagen_ziek_ex_zwanger)')} AS dagen_ziek_ex_zwanger,
       {_thousands('sum(dienstverband_dagen)')} AS dienstverband_dagen,
       {_percent_text('sum(dagen_ziek_ex_zwanger)', 'sum(dienstverband_dagen)')} AS verzuim_ex_zwanger
FROM mart GROUP BY jaar"""
    q["control_division"] = _with(STAGING, _mart()) + f"""
SELECT b.zorgbedrijf, m.jaar, m.maand,
       {_thousands('sum(m.dagen_ziek_ex_zwanger)')} AS dagen_ziek_ex_zwanger,
       {_thousands('sum(m.dienstverband_dagen)')} AS dienstverband_dagen,
       {_percent_text('sum(m.dagen_ziek_ex_zwanger)', 'sum(m.dienstverband_dagen)')} AS verzuim_ex_zwanger,
       {_dbl('sum(m.fte_realisatie)')} AS fte_realisatie
FROM mart m JOIN dwh_budgetplaatsen b ON m.kostenplaats_code = b.kostenplaats_code, params p
WHERE m.jaar IN (CAST(p.prv AS VARCHAR), CAST(p.cur AS VARCHAR)) AND b.zorgbedrijf = '{CONTROL_DIVISION}'
GROUP BY b.zorgbedrijf, m.jaar, m.maand"""
    q["absence_monthly"] = _with(STAGING, _mart(), MONTHLY) + "\nSELECT divisie, jaar, maand, zv, zvc FROM monthly"
    q["absence_pivot"] = _with(STAGING, _mart(), MONTHLY) + f"""
SELECT divisie AS zorgbedrijf, jaar, 'zv' AS bron,
       {_month_cols('zv2', ABSENCE_COLUMNS, 'max', None)}
FROM monthly, params p WHERE CAST(jaar AS INTEGER) IN (p.prv, p.cur) GROUP BY divisie, jaar
UNION ALL
SELECT divisie, jaar, 'zvc',
       {_month_cols('zvc2', ABSENCE_COLUMNS, 'max', None)}
FROM monthly, params p WHERE CAST(jaar AS INTEGER) IN (p.prv, p.cur) GROUP BY divisie, jaar"""
    q["fte_pivot"] = _with(STAGING, _mart(), _fte_pivot_rows(False))
    q["fte_pivot_with_total"] = _with(STAGING, _mart(), _fte_pivot_rows(True))
    q["absence_rowpct_pivot"] = _with(STAGING, _mart()) + f""",
r AS (
  SELECT b.zorgbedrijf, m.jaar, m.maand, {ROW_CENTS.replace('dagen_ziek_ex_zwanger', 'm.dagen_ziek_ex_zwanger').replace('dienstverband_dagen', 'm.dienstverband_dagen')} AS cents
  FROM mart m JOIN dwh_budgetplaatsen b ON m.kostenplaats_code = b.kostenplaats_code, params p
  WHERE b.zorgbedrijf IS NOT NULL AND m.jaar = CAST(p.cur AS VARCHAR)
)
SELECT zorgbedrijf, jaar,
       {", ".join(f"CAST(sum(CASE WHEN CAST(maand AS INTEGER) = {m} THEN coalesce(cents, 0) ELSE 0 END) AS DOUBLE) / 100.0 AS {n}" for m, n in enumerate(FTE_COLUMNS, start=1))}
FROM r GROUP BY zorgbedrijf, jaar"""
    q["absence_rowpct_total"] = _with(STAGING, _mart()) + f"""
SELECT '{ROWPCT_TOTAL_LABEL}' AS divisie, jaar,
       CAST(sum(CASE WHEN CAST(maand AS INTEGER) = 1 THEN {ROW_CENTS} ELSE 0 END) AS DOUBLE) / 100.0 AS jan
FROM mart, params p
WHERE jaar = CAST(p.cur AS VARCHAR) AND coalesce(dienstverband_dagen, 0) > 0
GROUP BY jaar"""
    q["absence_total_pivot"] = _with(STAGING, _mart()) + f""",
r AS (
  SELECT jaar, maand, {_cents('sum(dagen_ziek_ex_zwanger)', 'sum(dienstverband_dagen)')} AS pct
  FROM mart, params p WHERE jaar = CAST(p.cur AS VARCHAR) AND dienstverband_dagen > 0
  GROUP BY jaar, maand
)
SELECT '{ROWPCT_TOTAL_LABEL}' AS divisie, jaar,
       {", ".join(f"coalesce(max(CASE WHEN CAST(maand AS INTEGER) = {m} THEN pct END), 0.0) AS {n}" for m, n in enumerate(FTE_COLUMNS, start=1))}
FROM r GROUP BY jaar"""
    q["absence_year_total"] = _with(STAGING, _mart()) + f"""
SELECT '{ROWPCT_TOTAL_LABEL}' AS divisie, jaar,
       {_pct('sum(dagen_ziek_ex_zwanger)', 'sum(dienstverband_dagen)')} AS verzuim_ex_zwanger
FROM mart, params p WHERE jaar = CAST(p.cur AS VARCHAR) AND dagen_ziek_ex_zwanger > 0 GROUP BY jaar"""
    q["fte_mart_ytd_selfjoin"] = q["fte_mart_ytd"]
    q["kpi_lookup"] = _with() + f"""
SELECT d.* FROM dwh_dashboard d, params p
WHERE d.rap_periode = strftime(p.einddatum - INTERVAL 1 DAY, '%Y%m') AND d.rap_item = '{KPI_ITEM}' AND d.rap_code = '{KPI_CODE}'"""
    q["kpi_since"] = _with() + f"""
SELECT d.* FROM dwh_dashboard d, params p
WHERE d.rap_code = '{KPI_SINCE_CODE}' AND d.rap_item5 = '{KPI_ITEM5}'
  AND CAST(d.rap_periode AS INTEGER)
      > CAST(strftime(p.einddatum - INTERVAL 1 DAY - INTERVAL {KPI_SINCE_MONTHS} MONTH, '%Y%m') AS INTEGER)"""
    for name, src in (("relation_counts_formatie", "afas_mdw_formatie"), ("relation_counts_contracts", "dim_dienstverbanden")):
        q[name] = _with() + f"""
SELECT s.dienstbetrekking, l.omschrijving, count(*) AS aantal
FROM {src} s LEFT JOIN afas_dienstbetrekking l ON s.dienstbetrekking = l.tabelwaarde_code
GROUP BY 1, 2"""
    q["relation_enrich"] = _with() + """
SELECT d.dienstverband_id, d.werkgever_code, d.dienstbetrekking, d.type_werknemer,
       CASE WHEN EXISTS (SELECT 1 FROM afas_dienstbetrekking l WHERE l.tabelwaarde_code = d.dienstbetrekking)
            THEN (SELECT min(l.omschrijving) FROM afas_dienstbetrekking l WHERE l.tabelwaarde_code = d.dienstbetrekking)
            ELSE d.dienstbetrekking_oms END AS dienstbetrekking_oms
FROM dim_dienstverbanden d"""
    q["leave_reasons"] = _with() + "\nSELECT DISTINCT reden_uit_dienst_code FROM afas_dienstperiodes"
    q["duplicate_load_contracts"] = _with() + """
SELECT tabel, CAST(sum(n) AS BIGINT) AS rijen, CAST(count(*) AS BIGINT) AS unieke_rijen,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS dubbele_rijen, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS dubbele_groepen
FROM (SELECT tabel, count(*) AS n
      FROM (SELECT 'dim_dienstverbanden' AS tabel, * FROM dim_dienstverbanden
            UNION ALL SELECT 'dim_dienstverbanden dubbel geladen', * FROM dim_dienstverbanden
            UNION ALL SELECT 'dim_dienstverbanden dubbel geladen', * FROM dim_dienstverbanden WHERE werkgever_code = '5-LOW')
      GROUP BY tabel, dienstverband_id, werkgever_code, dienstbetrekking, type_werknemer, dienstbetrekking_oms)
GROUP BY tabel"""
    dims = (("ref_datum", "maand_id"), ("dim_medewerker_functies", "medewerker_functie_id"),
            ("dim_organisatie_eenheid", "organisatie_eenheid_id"), ("dim_dienstverbanden", "dienstverband_id"),
            ("dim_medewerkers", "medewerker_id"), ("dwh_budgetplaatsen", "kostenplaats_code"),
            ("afas_dienstbetrekking", "tabelwaarde_code"))
    q["dimension_key_duplicates"] = _with() + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS tabel, CAST({k} AS VARCHAR) AS sleutel, count(*) AS aantal FROM {t} GROUP BY {k} HAVING count(*) > 1"
        for t, k in dims
    )
    # a fact's first reason to be left out, in the load's order; NULL if it is loaded
    out_month = "WHEN NOT EXISTS (SELECT 1 FROM ref_datum c WHERE c.maand_id = f.maand_id) THEN 'maand'"
    out_contract = "WHEN NOT EXISTS (SELECT 1 FROM con_kept k WHERE k.dienstverband_id = f.dienstverband_id) THEN 'contract'"
    per_reason = lambda name, reasons: ", ".join(
        f"{_dbl(f"coalesce(sum(dagen) FILTER (WHERE soort = '{name}' AND reden = '{r}'), 0)")} AS uit_{name}_{r}" for r in reasons)
    q["mart_reconciliation"] = _with(STAGING, _mart()) + f""",
src AS (
  SELECT CAST(f.maand_id // 100 AS VARCHAR) AS jaar, 'dagen' AS soort, dienstverband_dagen AS dagen, CASE {out_month} {out_contract} END AS reden
  FROM fact_fte_realisatie f, params p WHERE f.groepering_id = '3' AND {YEARS}
  UNION ALL
  SELECT CAST(f.maand_id // 100 AS VARCHAR), 'ziek', dagen_ziek_ex_zwanger,
         CASE {out_month} {out_contract}
              WHEN NOT EXISTS (SELECT 1 FROM fn_kept k WHERE k.medewerker_functie_id = f.medewerker_functie_id) THEN 'functie'
              WHEN NOT EXISTS (SELECT 1 FROM org_kept k WHERE k.organisatie_eenheid_id = f.organisatie_eenheid_id) THEN 'eenheid'
              WHEN NOT EXISTS (SELECT 1 FROM dim_medewerkers k WHERE k.medewerker_id = f.medewerker_id) THEN 'medewerker'
              WHEN NOT coalesce(f.ziektepercentage <> 0, FALSE) THEN 'percentage' END
  FROM fact_fte_ziekteverzuim f, params p WHERE {YEARS}
),
g AS (
  SELECT jaar, sum(dagen) FILTER (WHERE soort = 'dagen') AS bd, coalesce(sum(dagen) FILTER (WHERE soort = 'dagen' AND reden IS NOT NULL), 0) AS ud,
         sum(dagen) FILTER (WHERE soort = 'ziek') AS bz, coalesce(sum(dagen) FILTER (WHERE soort = 'ziek' AND reden IS NOT NULL), 0) AS uz,
         {per_reason('dagen', REASONS_DAYS)}, {per_reason('ziek', REASONS_SICK)}
  FROM src GROUP BY jaar
),
m AS (SELECT jaar, sum(dienstverband_dagen) AS md, sum(dagen_ziek_ex_zwanger) AS mz FROM mart GROUP BY jaar)
SELECT g.jaar, {_dbl('bd')} AS bron_dagen, {_dbl('ud')} AS uit_dagen, {_dbl('bz')} AS bron_ziek, {_dbl('uz')} AS uit_ziek,
       {_dbl('md')} AS mart_dagen, {_dbl('mz')} AS mart_ziek, g.* EXCLUDE (jaar, bd, ud, bz, uz), (bd - ud = md AND bz - uz = mz) AS sluit
FROM g JOIN m ON g.jaar = m.jaar"""
    q["zero_denominators"] = _with(STAGING, _mart()) + f"""
SELECT 'maanden_zonder_dagen' AS controle, CAST(count(*) FILTER (WHERE aantal_dagen_maand IS NULL OR aantal_dagen_maand <= 0) AS BIGINT) AS aantal FROM ref_datum
UNION ALL
SELECT 'maanden_afwijkende_lengte', CAST(count(*) FILTER (WHERE aantal_dagen_maand > 0 AND aantal_dagen_maand NOT BETWEEN 28 AND 31) AS BIGINT) FROM ref_datum
UNION ALL
SELECT 'mart_rijen_zonder_dagen', CAST(count(*) FILTER (WHERE coalesce(dienstverband_dagen, 0) <= 0) AS BIGINT) FROM mart
UNION ALL
SELECT 'mart_rijen', CAST(count(*) AS BIGINT) FROM mart"""
    q["unknown_member_rate"] = _with(STAGING) + """
SELECT CAST(count(*) AS BIGINT) AS rijen,
       avg(CASE WHEN medewerker_id = 'Onbekend' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS medewerker_id_onbekend,
       avg(CASE WHEN kostenplaats_code = 'Onbekend' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS kostenplaats_code_onbekend,
       avg(CASE WHEN functiecode = 'Onbekend' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS functiecode_onbekend
FROM actual_rows"""
    q["unmatched_relations"] = _with() + """
SELECT d.dienstbetrekking, count(*) AS aantal FROM dim_dienstverbanden d
WHERE NOT EXISTS (SELECT 1 FROM afas_dienstbetrekking l WHERE l.tabelwaarde_code = d.dienstbetrekking)
GROUP BY 1"""
    q["unmatched_cost_centres"] = _with(STAGING, _mart()) + """
SELECT m.kostenplaats_code, count(*) AS aantal FROM mart m
WHERE NOT EXISTS (SELECT 1 FROM dwh_budgetplaatsen b WHERE b.kostenplaats_code = m.kostenplaats_code)
GROUP BY 1"""
    q["quarterly_series"] = _with(STAGING, _mart()) + f"""
SELECT jaar || ' Q' || CAST(CAST(ceil(CAST(maand AS INTEGER) / 3) AS BIGINT) AS VARCHAR) AS periode,
       {_dbl('sum(fte_realisatie)')} AS fte_maanden, {_dbl('sum(dienstverband_dagen)')} AS dienstverband_dagen,
       {_dbl('sum(CASE WHEN dagen_ziek_ex_zwanger > 0 THEN dagen_ziek_ex_zwanger END)')} AS dagen_ziek_ex_zwanger
FROM mart GROUP BY 1"""
    by_div = """,
zdiv AS (
  SELECT coalesce(b.zorgbedrijf, 'Onbekend') AS label, sum(m.z) AS z
  FROM (SELECT kostenplaats_code, sum(dagen_ziek_ex_zwanger) AS z FROM mart GROUP BY 1) m
  JOIN dwh_budgetplaatsen b ON m.kostenplaats_code = b.kostenplaats_code
  GROUP BY 1
)"""
    q["sick_days_by_division"] = _with(STAGING, _mart(), by_div) + f"\nSELECT label, {_dbl('z')} AS value FROM zdiv"
    share = f"{_pct('z', 'sum(z) OVER ()')}"
    q["sick_share_by_division"] = _with(STAGING, _mart(), by_div) + f"\nSELECT label, {_dbl('z')} AS value, {share} AS pct FROM zdiv"
    q["budget_vs_actual_by_year"] = _with(STAGING, _mart(include_budget=True)) + f"""
SELECT jaar AS y, {_dbl('sum(fte_begroot)')} AS a, {_dbl('sum(fte_realisatie)')} AS b FROM mart GROUP BY jaar"""
    q["days_by_year"] = _with(STAGING, _mart()) + f"""
SELECT jaar AS y, {_dbl('sum(dagen_ziek_ex_zwanger)')} AS a, {_dbl('sum(dienstverband_dagen)')} AS b FROM mart GROUP BY jaar"""
    q["daily_two_series"] = _with() + """,
a AS (SELECT dag, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS a_waarde FROM events_d WHERE event_type = 'purchase' GROUP BY dag),
b AS (SELECT dag, count(*) AS b_aantal FROM events_d WHERE event_type = 'view' GROUP BY dag)
SELECT strftime(coalesce(a.dag, b.dag), '%Y-%m-%d') AS dag, epoch_ms(CAST(coalesce(a.dag, b.dag) AS TIMESTAMP)) AS x_ms,
       a.a_waarde, b.b_aantal
FROM a FULL JOIN b ON a.dag = b.dag"""
    q["daily_bars"] = _with() + """
SELECT strftime(dag, '%Y-%m-%d') AS dag, epoch_ms(CAST(dag AS TIMESTAMP)) AS x_ms, strftime(dag, '%m/%d') AS label,
       count(*) AS aantal
FROM events_d GROUP BY dag"""
    q["latest_rows"] = _with() + """
SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS datum, strftime(ts, '%H:%M') AS tijd, value AS aantal
FROM events ORDER BY event_id DESC LIMIT 8"""
    q["load_feed"] = _with() + f"""
SELECT CASE WHEN fouten > 0 THEN '{LOAD_PROBLEM}' ELSE '{LOAD_OK}' END AS status,
       strftime(ts, '%-d-%-m-%Y %-H:%M') AS tijd, fouten
FROM (SELECT dag, max(ts) AS ts, count(*) FILTER (WHERE event_type = 'error') AS fouten FROM events_d GROUP BY dag)
ORDER BY ts DESC LIMIT 8"""
    q["absence_current_year"] = _with(STAGING, _mart(), MONTHLY) + f"""
SELECT CAST(maand AS INTEGER) AS maand, zv, zvc FROM monthly, params p
WHERE divisie = '{TOTAL_LABEL}' AND jaar = CAST(p.cur AS VARCHAR)"""
    q["absence_by_year"] = _with(STAGING, _mart()) + f"""
SELECT jaar, {_pct('sum(dagen_ziek_ex_zwanger)', 'sum(dienstverband_dagen)')} AS verzuim_ex_zwanger FROM mart GROUP BY jaar"""
    q["absence_by_function"] = _with(STAGING, _mart()) + f""",
g AS (SELECT functie_code, sum(dagen_ziek_ex_zwanger) AS z FROM mart GROUP BY 1)
SELECT functie_code AS label, {_dbl('z')} AS value, {share} AS pct FROM g"""
    q["contracts_by_relation"] = _with() + f""",
g AS (
  SELECT substr(CAST(f.maand_id AS VARCHAR), 1, 4) AS jaar, d.dienstbetrekking, count(DISTINCT f.dienstverband_id) AS contracten
  FROM fact_fte_realisatie f JOIN dim_dienstverbanden d ON f.dienstverband_id = d.dienstverband_id
  GROUP BY 1, 2
)
SELECT jaar, dienstbetrekking, contracten, {_pct('contracten', 'sum(contracten) OVER (PARTITION BY jaar)')} AS pct FROM g"""
    q["service_years"] = _with() + """,
s AS (SELECT medewerker_id, min(datum_in) AS start FROM afas_dienstperiodes GROUP BY 1)
SELECT CAST(year(p.einddatum) - year(start)
            - CASE WHEN month(p.einddatum) < month(start)
                     OR (month(p.einddatum) = month(start) AND day(p.einddatum) < day(start)) THEN 1 ELSE 0 END
            AS INTEGER) AS dienstjaren,
       count(*) AS medewerkers
FROM s, params p GROUP BY 1"""
    q["service_years_by_year"] = _with() + """,
s AS (SELECT medewerker_id, min(datum_in) AS start FROM afas_dienstperiodes GROUP BY 1),
r AS (
  SELECT make_date(CAST(y AS BIGINT), 12, 31) AS ref
  FROM (SELECT unnest(generate_series((SELECT year(min(start)) FROM s), (SELECT year(einddatum) - 1 FROM params))) AS y)
  UNION ALL SELECT einddatum FROM params
),
sr AS (SELECT s.start, r.ref FROM s, r WHERE s.start <= r.ref)
SELECT CAST(year(ref) AS INTEGER) AS jaar,
       CAST(year(ref) - year(start)
            - CASE WHEN month(ref) < month(start) OR (month(ref) = month(start) AND day(ref) < day(start))
                   THEN 1 ELSE 0 END AS INTEGER) AS dienstjaren,
       count(*) AS medewerkers
FROM sr GROUP BY 1, 2"""
    q["rolling_buffer"] = _with() + f""",
r AS (
  SELECT user_id, event_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events
),
k AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS cnt FROM r WHERE rn <= {ROLLING_N})
SELECT user_id, CAST(cnt - rn AS INTEGER) AS x,
       CASE WHEN value < 0 THEN 0.0 WHEN value > 100 THEN 100.0 ELSE value END AS y, event_id
FROM k"""
    q["rolling_buffer_stream"] = q["rolling_buffer"]
    q["published_mart"] = f"SELECT *, TRUE AS geladen FROM ({q['fte_mart_ytd']})"
    q["refreshed_mart"] = _with(STAGING, _mart()) + f"""
SELECT jaar, count(*) AS rijen, {_dbl('sum(dienstverband_dagen)')} AS dienstverband_dagen,
       CAST(count(*) FILTER (WHERE medewerker_id = 'Onbekend') AS BIGINT) AS onbekend
FROM mart, params p WHERE jaar <> CAST(p.cur AS VARCHAR) OR medewerker_id <> 'Onbekend' GROUP BY jaar"""
    q["appended_contracts"] = _with() + "\nSELECT dienstbetrekking, 2 * count(*) AS aantal FROM dim_dienstverbanden GROUP BY 1"
    q["truncated_contracts"] = _with() + "\nSELECT count(*) AS voor, CAST(0 AS BIGINT) AS na, CAST(5 AS INTEGER) AS kolommen FROM dim_dienstverbanden"
    q["updated_contracts"] = f"SELECT dienstbetrekking, dienstbetrekking_oms, count(*) AS aantal FROM ({q['relation_enrich']}) GROUP BY 1, 2"
    q["catalogue_inventory"] = _with() + """,
counts AS (""" + " UNION ALL ".join(f"SELECT '{t}' AS tabel, count(*) AS rijen FROM {t}" for t in dict.fromkeys(t for t, *_ in CATALOGUE)) + """),
cols(tabel, kolomnaam, type, length) AS (VALUES """ + ", ".join(f"('{t}', '{c}', '{k}', CAST({n} AS INTEGER))" for t, c, k, n in CATALOGUE) + """)
SELECT c.tabel, c.kolomnaam, c.type, c.length, n.rijen FROM cols c LEFT JOIN counts n ON c.tabel = n.tabel ORDER BY 1, 2"""
    q["stored_inventory"] = q["catalogue_inventory"]
    q["appended_mart"] = q["fte_mart_ytd"]
    q["actual_fte_bucketed"], q["sick_days_bucketed"] = q["actual_fte"], q["sick_days"]
    q["contracts_by_relation_kept"] = q["contracts_by_relation"]
    q["seasonal_days"] = _with() + f"""
SELECT c.jaar, count(*) AS rijen, {_dbl('sum(f.dienstverband_dagen)')} AS dienstverband_dagen
FROM fact_fte_realisatie f JOIN ref_datum c ON f.maand_id = c.maand_id WHERE f.groepering_id = '3' AND c.maandnummer <= 3 GROUP BY c.jaar ORDER BY c.jaar"""
    q["observed_checks"] = _with(STAGING, _mart()) + """
SELECT 'mart_rijen' AS controle, count(*) AS aantal FROM mart
UNION ALL SELECT 'mart_rijen_zonder_dagen', CAST(count(*) FILTER (WHERE coalesce(dienstverband_dagen, 0) <= 0) AS BIGINT) FROM mart
UNION ALL SELECT 'feit_rijen', count(*) FROM actual_rows
UNION ALL SELECT 'medewerker_id_onbekend', CAST(count(*) FILTER (WHERE medewerker_id = 'Onbekend') AS BIGINT) FROM actual_rows
UNION ALL SELECT 'kostenplaats_code_onbekend', CAST(count(*) FILTER (WHERE kostenplaats_code = 'Onbekend') AS BIGINT) FROM actual_rows
UNION ALL SELECT 'functiecode_onbekend', CAST(count(*) FILTER (WHERE functiecode = 'Onbekend') AS BIGINT) FROM actual_rows"""
    q["repeated_loads"] = _with() + """
SELECT 'eenmaal' AS tabel, count(*) AS rijen, CAST(1 AS BIGINT) AS keer FROM dim_dienstverbanden
UNION ALL SELECT 'tweemaal', 2 * count(*), CAST(2 AS BIGINT) FROM dim_dienstverbanden
UNION ALL SELECT 'gedeeltelijk', count(*) + CAST(count(*) FILTER (WHERE werkgever_code = '5-LOW') AS BIGINT), CAST(0 AS BIGINT) FROM dim_dienstverbanden"""
    counted = (("ref_datum", "maand_id"), ("dim_medewerker_functies", "medewerker_functie_id"), ("dim_organisatie_eenheid", "organisatie_eenheid_id"),
               ("dim_dienstverbanden", "dienstverband_id"), ("fact_fte_realisatie", "dienstverband_id"))
    q["dimension_key_counts"] = _with() + "\n" + "\nUNION ALL ".join(
        f"SELECT '{t}' AS tabel, count(*) AS rijen, count(DISTINCT {k}) AS unieke_sleutels, count(*) - count({k}) AS zonder_sleutel, count({k}) - count(DISTINCT {k}) AS dubbel FROM {t}"
        for t, k in counted)
    q["two_series"] = """
SELECT epoch_us(ts) AS x, strftime(ts, '%Y-%m-%d %I:%M') AS tijd, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, CAST(a AS VARCHAR) || '€' AS a_label
FROM (SELECT ts, sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase') AS a, sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'view') AS b
      FROM events WHERE event_type IN ('purchase', 'view') AND ts IS NOT NULL GROUP BY ts) ORDER BY ts"""
    return q
