"""Explicit schemas of the personnel tables (the warehouse ships no DDL; types chosen here)."""

from __future__ import annotations


# DDL strings: ``DataFrameReader.schema`` and ``createDataFrame`` accept them directly.
SCHEMAS: dict[str, str] = {
    "fact_fte_begroting": (
        "maand_id int, medewerker_functie_id bigint, organisatie_eenheid_id bigint, "
        "fte_begroot_dagen decimal(18,6), groepering_id string"
    ),
    "fact_fte_realisatie": (
        "medewerker_id bigint, dienstverband_id bigint, medewerker_functie_id bigint, "
        "organisatie_eenheid_id bigint, dienstverband_dagen decimal(18,6), groepering_id string, maand_id int"
    ),
    "fact_fte_ziekteverzuim": (
        "medewerker_id bigint, dienstverband_id bigint, medewerker_functie_id bigint, "
        "organisatie_eenheid_id bigint, dagen_ziek_ex_zwanger decimal(18,6), ziektepercentage double, maand_id int"
    ),
    "ref_datum": "maand_id int, jaar int, maandnummer int, aantal_dagen_maand int",
    "dim_medewerker_functies": (
        "medewerker_functie_id bigint, medewerker_functie_code string, medewerker_functie_naam string"
    ),
    "dim_organisatie_eenheid": (
        "organisatie_eenheid_id bigint, kostenplaats_code string, afdeling_code string, cluster_code string"
    ),
    "dim_dienstverbanden": (
        "dienstverband_id bigint, werkgever_code string, dienstbetrekking string, type_werknemer string, "
        "dienstbetrekking_oms string"
    ),
    "dim_medewerkers": "medewerker_id bigint",
    "dwh_budgetplaatsen": "kostenplaats_code string, zorgbedrijf string",
    "dwh_rap_periode": "package_naam string, rapport_einddatum date",
    "dwh_dashboard": "rap_periode string, rap_item string, rap_code string, rap_waarde bigint, rap_item5 string",
    "afas_mdw_formatie": "medewerker_id bigint, dienstbetrekking string",
    "afas_dienstbetrekking": "tabelwaarde_code string, omschrijving string",
    "afas_dienstperiodes": "medewerker_id bigint, datum_in date, reden_uit_dienst_code string",
}

# The given star schema, so that opening one of its tables reads no file footers.
RAW_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
