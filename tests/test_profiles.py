from limes.operators import policy
from limes.sources import profiles


def test_profiles_by_rule(spark):
    levels = profiles.level_table(spark)
    assert levels.count() == levels.select("country").distinct().count() > 150
    row = profiles.default_profiles(levels).filter("country = 'be'").first()
    assert row.name_keys == ["name:en", "name", "official_name", "name:be"] and row.languages == ["en", "be"]
    special = spark.createDataFrame([("be", 8, None)], "country string, level int, tolerance double")
    got = {r.level: r.tolerance for r in profiles.level_policies(levels, special).filter("country = 'be'").collect()}
    assert got == {4: 0.01, 6: 0.001, 8: None}
    near = spark.createDataFrame([("be", 5.0, None)], "country string, nearby_km double, offshore_km double")
    assert tuple(profiles.nearby_policy(levels, near).filter("country = 'be'").first()) == ("be", 5.0, 20.0)


def test_shapes_of_a_country(spark):
    levels = profiles.level_table(spark).filter("country = 'be'")
    shapes = policy.default_policy(policy.level_shapes(levels), levels)
    assert {r["shape"]: r.status for r in shapes.collect()} == {"4": "partial", "6": "partial", "8": "partial", "4-6": "partial", "4-8": "partial", "6-8": "partial", "4-6-8": "ok"}


def test_shape_policies_by_country(spark):
    levels = profiles.level_table(spark)
    rows = policy.shape_policies(levels, profiles.shape_alternatives(spark), profiles.listed_shapes(spark)).collect()
    got = {(r.country, r["shape"]): r.status for r in rows}
    assert len(got) == len(rows)
    assert {c for c, _ in got} == {r.country for r in levels.collect()}
    of = lambda country, status: {s for (c, s), t in got.items() if (c, t) == (country, status)}
    assert of("nz", "ok") == {"4-6", "4-6-8", "6-8"} and of("nz", "partial") == {"4", "4-8", "6", "8"}
    assert of("jp", "ok") == {"3-4", "3-4-7", "3-7"} and len(of("jp", "partial")) == 4
    assert of("tw", "ok") == {"4", "4-7", "4-8", "4-7-8"} and not of("tw", "partial")
    assert of("pt", "ok") == {"4-7", "4-7-8", "6-7", "6-7-8"} and ("pt", "4-6-7") not in got
    assert of("au", "ok") == {"4-6", "4-7"} and got["au", "4-6-7"] == "partial"
    assert of("ie", "ok") == {"5-6-7-8-9"} and not of("ca", "partial")
    assert got["ke", "2-10"] == "ok" and got["ke", "1"] == "partial"
    assert got["fj", "2"] == "ok" and got["fj", "4-6"] == "partial"


def test_status_by_country(spark):
    from limes.operators import lookup

    points = spark.createDataFrame([(1, "nz"), (2, "at"), (3, None), (4, "nz"), (5, "xx"), (6, "pt")], "pid int, country string")
    hits = spark.createDataFrame([(p, "f", lv) for p, both in ((1, (6, 8)), (2, (6, 8)), (3, (4,)), (5, (4,)), (6, (4, 6, 7))) for lv in both], "pid int, feature_id string, level int")
    policies = policy.shape_policies(profiles.level_table(spark), profiles.shape_alternatives(spark), profiles.listed_shapes(spark))
    got = {r.pid: (r["shape"], r.status) for r in lookup.lookup_shapes_by_country(points, hits, policies).collect()}
    assert got == {1: ("6-8", "ok"), 2: ("6-8", "partial"), 3: ("4", "failed"), 4: ("", "failed"), 5: ("4", "failed"), 6: ("4-6-7", "failed")}
