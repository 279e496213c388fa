"""Registered queries against their SQL counterpart on the smallest test tables."""

import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F

from benthoframe.plans.oracle import ORACLE
from benthoframe.operators import bioconversion
from benthoframe.plans import pipeline, queries
from benthoframe.plans.queries import QUERIES

@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def comparable(rows, names, order):
    def cell(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        return repr(float(v) + 0.0) if isinstance(v, (int, float)) else str(v)

    index = [names.index(c) for c in order]
    return sorted(tuple(cell(r[i]) for i in index) for r in rows)


def compare(spark, db, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    result = db.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    mine = comparable(df.collect(), df.columns, order)
    assert mine and mine == comparable(result.fetchall(), names, order)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_rare_rows_are_there(spark):
    """Each rare case is in the result it is about."""
    run = lambda name: QUERIES[name](spark, SF)
    assert run("totals_fuzzy_names").filter("isFuzzy").count() > 0
    totals = run("rare_totals")
    assert totals.filter("isFuzzy").count() > 0 and totals.filter("isFuzzy IS NULL").count() > 0
    assert totals.groupBy("StationID", "valid_name").agg(F.count_distinct("File").alias("n")).filter("n > 1").count() > 0
    densities = run("rare_densities")
    assert totals.count() > densities.count()  # stations that are not listed
    assert densities.filter("Sample_area_m2 = 0 AND Density_nr_per_m2 IS NULL").count() > 0
    assert densities.filter("Sample_area_m2 IS NULL AND Density_nr_per_m2 IS NULL").count() > 0
    values = run("rare_community_values")
    assert values.filter("value IS NULL").count() > 0 and values.filter("taxon IS NULL AND value > 0").count() > 0
    wide = run("rare_community_matrix")
    assert wide.filter("NA > 0").count() > 0 and wide.filter("NA IS NULL").count() > 0 and wide.filter("fam_bo = 0").count() > 0
    assert run("rare_upscale").filter("AFDW_g IS NULL").count() > 0
    found = run("rare_regressions")
    assert found.filter("Size_dimension IS NULL AND A_factor IS NOT NULL").count() > 0 and found.filter("A_factor IS NULL").count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    compare(spark, db, name, SF)


def test_plans(spark):
    """No Cartesian product, no UDF but the geodesics, filters and columns reach the scan."""
    import contextlib
    import io

    def plan(name):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            QUERIES[name](spark, SF).explain("formatted")
        return text.getvalue()

    flagship = plan("density_by_station_taxon")
    assert "CartesianProduct" not in flagship and "BroadcastNestedLoopJoin" not in flagship
    assert flagship.count("ArrowEvalPython") == plan("track_bearing").count("ArrowEvalPython")
    totals = plan("totals_by_station_taxon")
    assert "Python" not in totals and "l_tax" not in totals and "l_shipdate" not in totals
    assert "BroadcastHashJoin" in totals


def largest_method(spark, df):
    """Bytes of the largest generated method of a plan without adaptive execution."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = df._jdf.queryExecution()
        plan = df._jdf.sparkSession().sessionState().executePlan(execution.logical(), execution.mode()).executedPlan()
        stages = getattr(spark._jvm, "org.apache.spark.sql.execution.debug.package$").__getattr__("MODULE$").codegenStringSeq(plan)
        return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", [
    "density_by_station_taxon", "individuals", "cleaned_entries", "totals_by_station_taxon", "species_biomass", "violations_row_rules"])
def test_generated_methods_are_compiled(spark, name):
    """The JVM compiles no method of more than 8,000 bytes."""
    assert 0 < largest_method(spark, QUERIES[name](spark, SF)) < 8000


@pytest.mark.parametrize("name", ["sample_conflict", "water_depth"])
def test_lookups_too_large_to_broadcast(spark, db, name):
    """The way beyond the broadcast threshold: sort-merge joins, same rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        compare(spark, db, name, SF)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name, reads", [("sample_conflict", 2), ("totals_fuzzy_names", 2), ("sample_conflict_per_station", 3)])
def test_passes_over_the_entries(spark, monkeypatch, name, reads):
    """Names and conflicts take one pass; conflicts of stations one of their own, with its filter below the joins."""
    plans = []

    def noted(df, label, settle=queries.settle):
        plans.append((label, df._jdf.queryExecution().optimizedPlan().toString()))
        return settle(df, label)

    for module in (queries, pipeline, bioconversion):
        monkeypatch.setattr(module, "settle", noted)
    final = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert sum(plan.count("Relation [l_orderkey") for _, plan in (*plans, ("", final))) == reads
    assert "CollectMetrics" not in dict(plans)["conflicts"] and "CollectMetrics" in final
