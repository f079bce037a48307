"""S5 publish without a gap, S7 touched partitions, S6 maintenance after an append."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from staffmart.config import MartOptions
from staffmart.operators import maintain
from staffmart.operators import mart as M
from staffmart.operators.publish import publish_table, published, update_from, update_partitions
from staffmart.sources.params import report_period
from staffmart.sources.tables import FACTS


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def table(tmp_path, request):
    name = f"t_{abs(hash(request.node.name))}"
    return str(tmp_path / "wh"), name


def frame(spark, *rows_):
    return spark.createDataFrame(rows_, "k int, v string, jaar string")


def test_publish_replaces_all_or_some_partitions_and_keeps_two_versions(spark, table):
    from pathlib import Path

    base, name = table
    loads = lambda year: sorted(p.name for p in Path(base, name, f"jaar={year}").iterdir())
    a = publish_table(frame(spark, (1, "a", "2000"), (2, "b", "2001")), base, name)
    assert rows(a) == [(1, "a", "2000"), (2, "b", "2001")] and a.schema == frame(spark, (1, "a", "2")).schema
    old = {f for f in a.inputFiles() if "jaar=2000" in f}
    b = publish_table(frame(spark, (3, "c", "2001")), base, name, only_its_partitions=True, notes={"why": "test"})
    assert rows(b) == [(1, "a", "2000"), (3, "c", "2001")] and published(spark, name)["why"] == "test"
    assert {f for f in b.inputFiles() if "jaar=2000" in f} == old
    # a reader that began on the first version still finds its files
    assert rows(a) == [(1, "a", "2000"), (2, "b", "2001")] and len(loads(2001)) == 2
    publish_table(frame(spark, (4, "d", "2001")), base, name, only_its_partitions=True)
    publish_table(frame(spark, (5, "e", "2001")), base, name, only_its_partitions=True)
    assert len(loads(2001)) == 2 and len(loads(2000)) == 1
    gone = publish_table(frame(spark, (6, "f", "2002")), base, name, only_its_partitions=True, emptied=[("2000",)])
    assert rows(gone) == [(5, "e", "2001"), (6, "f", "2002")]
    assert rows(publish_table(frame(spark, (7, "g", "2003")), base, name)) == [(7, "g", "2003")]
    assert rows(publish_table(frame(spark, (7, "g", "2003")).where("false"), base, name)) == []


def test_a_failed_load_changes_nothing(spark, table):
    base, name = table
    publish_table(frame(spark, (1, "a", "2000")), base, name)
    bad = frame(spark, (2, "b", "2000"), (3, "c", "2001")).withColumn("v", F.when(F.col("k") == 3, F.raise_error("stopped")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stopped"):
        publish_table(bad, base, name)
    assert rows(spark.table(name)) == [(1, "a", "2000")]
    assert rows(publish_table(frame(spark, (2, "b", "2000")), base, name)) == [(2, "b", "2000")]


def test_update_rewrites_matched_partitions_only(spark, tmp_path):
    from pathlib import Path

    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, f"v{i}", i % 5 if i % 5 else None) for i in range(50)], "k int, v string, p int")
    df.write.partitionBy("p").parquet(path)
    files = lambda: {str(f) for f in Path(path).rglob("*.parquet")}
    before = files()
    updates = spark.createDataFrame([(7, "x"), (12, "y"), (5, "null partition"), (999, "nobody")], "k int, v string")
    touched = update_partitions(spark, path, df.schema, ["p"], updates, ["k"], ["v"])
    assert sorted(touched, key=repr) == [(2,), (None,)]
    kept = {f for f in before if "p=2" not in f and "DEFAULT" not in f}
    assert kept and kept <= files() and not (before - kept) & files()
    assert rows(spark.read.schema(df.schema).parquet(path)) == rows(update_from(df, updates, ["k"], ["v"]))
    assert update_partitions(spark, path, df.schema, ["p"], updates.where("k = 999"), ["k"], ["v"]) == []
    with pytest.raises(ValueError):
        update_partitions(spark, path, df.schema, ["p"], df, ["k"], ["p"])


def of(fx, cond):
    return fx.replace(**{n: getattr(fx, n).where(cond) for n in FACTS})


def exact(spark, t, years):
    return rows(M.fte_mart(t, years).select(*sorted(M.fte_mart(t, years).columns)))


def stored(df):
    mart = maintain.mart_of(df)
    return rows(mart.select(*sorted(mart.columns)))


def test_late_month_gives_the_rebuilds_rows(spark, fx, table):
    base, name = table
    years = report_period(fx.dwh_rap_periode)[1]
    late = F.col("maand_id") == 201601
    first = maintain.start(of(fx, ~late), years, base, name)
    assert stored(first) == exact(spark, of(fx, ~late), years)
    got = maintain.add_load(spark, of(fx, late), years, base, name, "2016-01")
    assert stored(got) == exact(spark, fx, years)
    # the same load again changes nothing, another one of the same rows counts
    assert stored(maintain.add_load(spark, of(fx, late), years, base, name, "2016-01")) == exact(spark, fx, years)
    twice = maintain.add_load(spark, of(fx, late), years, base, name, "2016-01 again")
    both = fx.replace(**{n: getattr(fx, n).unionByName(getattr(fx, n).where(late)) for n in FACTS})
    assert stored(twice) == exact(spark, both, years)
    # and can be taken back; taken back wholly, the month's keys are gone
    assert stored(maintain.add_load(spark, of(fx, late), years, base, name, "back 1", sign=-1)) == exact(spark, fx, years)
    assert stored(maintain.add_load(spark, of(fx, late), years, base, name, "back 2", sign=-1)) == exact(spark, of(fx, ~late), years)
    assert published(spark, name)["loads"] == "start,2016-01,2016-01 again,back 1,back 2"


def test_budget_rows_and_an_empty_load(spark, fx, table):
    base, name = table
    years, opts = report_period(fx.dwh_rap_periode)[1], MartOptions(include_budget=True)
    maintain.start(of(fx, F.lit(False)), years, base, name, opts)
    got = maintain.add_load(spark, fx, years, base, name, "all", opts)
    want = M.fte_mart(fx, years, opts)
    assert stored(got) == rows(want.select(*sorted(want.columns)))
    assert stored(maintain.add_load(spark, of(fx, F.lit(False)), years, base, name, "nothing", opts)) == stored(got)


def test_a_load_reads_only_its_own_files_and_rewrites_its_own_partitions(spark, fx, tmp_path, table):
    base, name = table
    years = report_period(fx.dwh_rap_periode)[1]
    late = F.col("maand_id") == 201602
    new = {}
    for fact in FACTS:
        getattr(fx, fact).where(late).write.parquet(str(tmp_path / "new" / fact))
        new[fact] = spark.read.schema(getattr(fx, fact).schema).parquet(str(tmp_path / "new" / fact))
    t = fx.replace(**new)
    delta = maintain.load_sums(t, years)
    assert delta.inputFiles() and all("/new/" in f for f in delta.inputFiles())
    first = maintain.start(of(fx, ~late), years, base, name)
    before = set(first.inputFiles())
    got = maintain.add_load(spark, t, years, base, name, "2016-02")
    assert stored(got) == exact(spark, fx, years)
    touched = {(r.jaar, r.emmer) for r in delta.select("jaar", maintain.bucket()).distinct().collect()}
    untouched = {f for f in before if not any(f"jaar={y}/emmer={e}/" in f for y, e in touched)}
    assert untouched and untouched <= set(got.inputFiles())
    assert not (before - untouched) & set(got.inputFiles())
    # a failed load leaves the mart as it was
    bad = t.replace(fact_fte_realisatie=t.fact_fte_realisatie.withColumn("dienstverband_dagen", F.expr("cast(raise_error('stopped') as decimal(18,6))")))
    want = stored(spark.table(name))
    with pytest.raises(Exception, match="stopped"):
        maintain.add_load(spark, bad, years, base, name, "bad")
    assert stored(spark.table(name)) == want and "bad" not in published(spark, name)["loads"]
