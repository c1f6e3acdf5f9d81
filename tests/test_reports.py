"""Report invariants on the mart built from sf0.001, independent of the oracle."""

from pyspark.sql import functions as F

from blotter.plans.queries import full_star


def _sum(df, col):
    return df.agg(F.sum(col)).first()[0] or 0


def test_area_monthly_counts_every_fact(spark, sf_small):
    star = full_star(spark, sf_small)
    assert _sum(star.report("area_monthly_summary"), "crime_count") == star.table("fct_incidents").count()


def test_shares_add_up_within_their_groups(spark, sf_small):
    star = full_star(spark, sf_small)
    cases = [("crime_code_seasonality", ["crime_code"], "crime_count", "total_by_crime", "month_percentage"),
             ("victim_demographics", ["victim_age", "victim_sex"], "incident_count", "total_by_age_sex",
              "descent_percentage"),
             ("weapon_distribution", ["area_name", "part_of_day"], "weapon_count", "total_crimes",
              "weapon_type_percentage"),
             ("location_density", ["lat_bucket", "lon_bucket"], "crime_count", "total_crimes_in_grid",
              "crime_density_percentage")]
    for name, part, count, total, pct in cases:
        df = star.report(name)
        g = df.groupBy(*part).agg(F.sum(count).alias("s"), F.max(total).alias("t"),
                                  F.min(total).alias("t0"), F.sum(pct).alias("p"))
        bad = g.filter((F.col("s") != F.col("t")) | (F.col("t") != F.col("t0"))
                       | (F.abs(F.col("p") - 100) > 0.01 * F.col("s") + 0.01)).count()
        assert bad == 0, name


def test_report_totals_match_the_fact(spark, sf_small):
    star = full_star(spark, sf_small)
    fact, bridge = star.table("fct_incidents"), star.table("bridge_crime_code")
    coded = fact.join(bridge, "dr_no").count()
    assert _sum(star.report("crime_code_seasonality"), "crime_count") == coded
    assert _sum(star.report("location_density"), "crime_count") == coded
    assert _sum(star.report("victim_demographics"), "incident_count") == \
        fact.filter(F.col("victims_id").isNotNull()).count()
    assert _sum(star.report("weapon_distribution"), "weapon_count") == \
        fact.filter(F.col("weapons_id").isNotNull()).count()


def test_reports_come_in_their_order(spark, sf_small):
    from blotter.plans import pipeline as P
    from blotter.plans.queries import full_star
    star = full_star(spark, sf_small)
    # The order each report declares, nulls last.
    orders = {"area_monthly_summary": ["area_code", "area_name", "year", "month"],
              "crime_code_seasonality": ["crime_code", "month_number"],
              "location_density": ["lat_bucket", "lon_bucket", "crime_code", "year", "month_number"],
              "victim_demographics": ["victim_age", "victim_sex", "victim_descent"],
              "weapon_distribution": ["area_name", "part_of_day", "weapon_type"]}
    assert set(orders) == set(P.REPORTS)
    for name, cols in orders.items():
        keys = [tuple((r[c] is None, r[c] if r[c] is not None else 0) for c in cols) for r in star.report(name).collect()]
        assert len(keys) > 1 and keys == sorted(keys), name
