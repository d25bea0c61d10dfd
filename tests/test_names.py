import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from limes.functions import names as N
from limes.operators import select
from limes.sources import tables


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def tags(**kv):
    return F.create_map(*(F.lit(x) for k, v in kv.items() for x in (k.replace("__", ":").replace("_d_", "-"), v)))


def test_first_name_that_is_not_empty(spark):
    t = tags(name="", name__en="A", official_name="B")
    assert one(spark, N.pick_name(t, ["name", "name:en", "official_name"])) == "A"
    assert one(spark, N.pick_name(t, F.array(F.lit("x"), F.lit("official_name")))) == "B"
    assert one(spark, N.pick_name(t, ["nothing"])) is None


def test_aliases_drop_repeated_languages_and_texts(spark):
    t = tags(name__en=" One ", name__EN="Other", name__de="One", name__fr="Un", name__zh_d_hant="Hant", name__zz_d_top="no")
    assert one(spark, N.alias_names(t, ["zh-Hant"])) == {"de": "One", "fr": "Un", "zh-Hant": "Hant", "en": "Other"}
    assert one(spark, N.alias_names(tags(name__en=" "), [])) is None
    assert one(spark, N.alias_names(tags(short="S"), [], extra=[("short", "en")])) == {"en": "S"}


def test_levels_codes_and_ids(spark):
    assert one(spark, N.level_of(F.lit("06"))) == 6
    assert one(spark, N.level_of(F.lit("6a"))) is None
    assert one(spark, N.country_code(F.lit(" UK "))) == "gb"
    assert one(spark, N.runtime_id(F.lit("pt_r1"), "pt")) == "r1"
    assert one(spark, N.level_label(F.lit(7))) == "admin_locality" and one(spark, N.level_label(F.lit(11))) == "admin_level_11"


def test_empty_level_list_is_an_error(spark):
    with pytest.raises(ValueError):
        select.admin_hierarchy_relations(spark.createDataFrame([(1, {"a": "b"})], "id long, tags map<string,string>"), [])


def test_missing_extracts_are_all_named(spark):
    with pytest.raises(FileNotFoundError, match="b, c"):
        tables.require_extracts(spark.createDataFrame([("a",)], "extract string"), ["a", "c", "b"])


def test_unused_file_filter(spark):
    rows = spark.createDataFrame([("x-latest.osm.pbf", False), ("planet.osm.pbf", False), ("x-latest.osm.pbf", True)], "name string, has_boundary boolean")
    assert [r.filtered for r in select.needs_country_filter(rows).collect()] == [False, True, True]


def test_country_codes_lose_white_space_of_any_kind(spark):
    rows = spark.createDataFrame([("\t De\n",), (" UK ",), ("\x1cfr\x85",)], "c string")
    assert [r.code for r in rows.select(N.country_code(F.col("c")).alias("code")).collect()] == ["de", "gb", "fr"]
    for bad in ("  ", None):
        with pytest.raises(PySparkException, match="empty country"):
            spark.createDataFrame([(bad,)], "c string").select(N.country_code(F.col("c"))).collect()
