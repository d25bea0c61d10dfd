"""Country profiles: which levels a country has, and how names and borders are treated, as small tables.

All countries run in one job, so operators join these tables by country (and level); they have a row for each country or level of a
country, whatever the data, which is what bounds their broadcast.  A deployment may give its own tables of the same schemas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Administrative levels by country code.
LEVELS = {
    "AE": [2, 3, 4, 5, 6, 7, 8, 9, 10, 11],
    "AF": [4, 5, 7, 10],
    "AL": [4, 6, 7, 8],
    "AM": [4, 5, 6, 7, 8, 10],
    "AO": [2, 4, 5, 6, 7, 8],
    "AR": [4, 5, 8],
    "AT": [4, 6, 8],
    "AU": [4, 6, 7],
    "AZ": [2, 3, 4, 5, 6, 7, 8],
    "BA": [4, 5, 6, 7, 8],
    "BD": [2, 4, 5, 6, 7, 8, 9, 10],
    "BE": [4, 6, 8],
    "BF": [4, 5, 6, 8],
    "BG": [4, 5, 6],
    "BH": [2, 3, 4, 5, 6, 7, 8, 9, 10, 11],
    "BI": [2, 4, 6, 8],
    "BJ": [2, 4, 6, 7, 8],
    "BN": [2, 3, 4, 5, 6, 7, 8, 10, 11, 14],
    "BO": [4, 6, 8, 9, 10],
    "BR": [4, 8],
    "BS": [8, 9],
    "BT": [4, 5, 6, 8, 9, 10],
    "BW": [2, 4, 6, 8, 10],
    "BY": [2, 4, 6, 8],
    "BZ": [4, 7, 8, 9, 10, 11],
    "CA": [4, 5, 6, 7, 8],
    "CD": [2, 4, 6, 7, 8, 9, 10],
    "CF": [2, 4, 6, 8, 9, 10],
    "CG": [2, 4, 5, 6, 7, 8, 9, 10],
    "CH": [4, 6, 8],
    "CI": [2, 4, 5, 6, 7, 8, 9, 10],
    "CK": [2, 4, 6, 8, 10],
    "CL": [4, 6, 8],
    "CM": [2, 4, 6, 7, 8, 9, 10],
    "CN": [4, 5, 6],
    "CO": [4, 6, 8],
    "CR": [4, 6, 8, 10],
    "CU": [4, 6, 7, 8, 9, 10, 11],
    "CV": [2, 6, 7, 8, 9, 10],
    "CY": [5, 6, 8, 9],
    "CZ": [4, 6, 7, 8],
    "DE": [4, 5, 6, 8],
    "DJ": [2, 4, 6, 8, 9],
    "DK": [4, 7],
    "DO": [4, 6, 10],
    "DZ": [2, 4, 6, 7, 8, 10, 11],
    "EC": [4, 6, 8, 9, 10],
    "EE": [6, 7],
    "EG": [2, 4, 6, 7, 8, 9, 10],
    "ER": [2, 4, 8, 9],
    "ES": [4, 6, 8],
    "ET": [4, 5, 6, 8, 10],
    "FI": [4, 7, 8],
    "FJ": [2, 4, 6, 8, 10],
    "FM": [2, 4, 6, 8, 10],
    "FR": [4, 6, 8],
    "GA": [2, 4, 5, 6, 9],
    "GB": [4, 5, 6, 7, 8],
    "GE": [4, 6, 8, 10],
    "GH": [2, 4, 6, 7, 8, 9],
    "GL": [2, 4, 5],
    "GM": [2, 4, 5, 6, 7, 8, 9, 10],
    "GN": [2, 4, 6, 7, 8, 10, 11],
    "GQ": [2, 3, 4, 5, 6, 8],
    "GR": [3, 4, 5, 6, 7, 8],
    "GT": [4, 6, 8, 10],
    "GW": [2, 3, 4, 6, 8],
    "GY": [4, 6, 8, 10],
    "HK": [3, 4, 5, 6, 7, 8, 9],
    "HN": [4, 6, 7, 8, 9, 10, 12],
    "HR": [4, 7],
    "HT": [4, 5, 8, 10, 11],
    "HU": [6, 7, 8, 9],
    "ID": [4, 5, 6, 7],
    "IE": [5, 6, 7, 8, 9],
    "IL": [2, 4, 5, 6, 7, 8, 9, 10, 11],
    "IN": [4, 5, 6],
    "IQ": [2, 3, 4, 5, 6, 7, 8, 9],
    "IR": [4, 5, 6, 7],
    "IS": [5, 6, 9, 10],
    "IT": [4, 6, 8],
    "JM": [5, 6, 8, 9],
    "JO": [2, 4, 5, 6, 8, 9, 10],
    "JP": [3, 4, 7],
    "KE": [1, 2, 3, 4, 6, 7, 8, 9, 10, 12],
    "KG": [2, 4, 6, 7, 8, 9, 10],
    "KH": [1, 2, 4, 6, 8],
    "KI": [2, 4, 6, 8, 10],
    "KM": [2, 4, 6, 8],
    "KP": [2, 4, 6, 7, 8, 10],
    "KR": [4, 6, 8],
    "KW": [2, 3, 4, 5, 6, 7, 8, 9, 10, 11],
    "KZ": [2, 4, 6, 7, 8, 9, 10],
    "LA": [2, 4, 6, 7, 8, 10],
    "LB": [2, 4, 5, 7, 8],
    "LK": [2, 3, 4, 5, 6, 7, 8, 9, 10],
    "LR": [2, 4, 6, 8, 9, 10],
    "LS": [2, 5, 6],
    "LT": [4, 5, 6, 8],
    "LU": [6, 8, 9],
    "LV": [5, 7, 8, 9],
    "LY": [2, 4, 6, 9],
    "MA": [2, 4, 5, 6, 7, 8, 9, 10, 11],
    "MC": [8, 10],
    "MD": [4, 8, 9],
    "ME": [6, 8, 9],
    "MG": [2, 3, 4, 6, 7, 8, 9, 10, 11],
    "MH": [2, 4, 6, 8, 10],
    "MK": [7, 8, 9],
    "ML": [2, 4, 6, 7, 8, 10],
    "MM": [2, 3, 4, 5, 6, 7, 8, 9, 10],
    "MN": [2, 4, 6, 7, 8],
    "MO": [5, 6],
    "MR": [2, 4, 6, 8],
    "MU": [2, 3, 4, 8, 9, 10],
    "MV": [2, 4, 8, 9],
    "MW": [2, 3, 4, 5, 10],
    "MX": [4, 6],
    "MY": [4, 5, 6, 7, 8, 10],
    "MZ": [2, 3, 4, 5, 6, 8, 10],
    "NA": [2, 4, 5, 6, 7, 8, 9, 10, 11, 12],
    "NC": [2, 4, 6, 8, 10],
    "NE": [2, 4, 6, 7, 8, 9],
    "NG": [4, 6, 7, 8, 10],
    "NI": [4, 6, 8, 9, 10, 11, 12],
    "NL": [4, 8],
    "NO": [4, 7],
    "NP": [2, 4, 6, 7, 8, 9, 10, 11],
    "NR": [2, 4, 6, 8, 10],
    "NU": [2, 4, 6, 8, 10],
    "NZ": [4, 6, 8],
    "OM": [2, 3, 4, 5, 6, 7, 8, 9, 10, 11],
    "PA": [4, 6, 7, 8, 9, 10, 11],
    "PE": [4, 6, 8],
    "PF": [2, 4, 6, 8, 10],
    "PG": [2, 4, 6, 8, 10],
    "PH": [4, 6, 10],
    "PK": [2, 4, 5, 6, 7, 8, 9, 10, 11],
    "PL": [4, 6, 7],
    "PN": [2, 4, 6, 8, 10],
    "PS": [2, 4, 5, 6, 7, 8, 9, 10, 11],
    "PT": [4, 6, 7, 8],
    "PW": [2, 4, 6, 8, 10],
    "PY": [4, 6, 7, 8, 9, 10],
    "QA": [2, 3, 4, 5, 6, 7, 8, 9, 10, 11],
    "RO": [4, 8],
    "RS": [6, 8],
    "RU": [4, 5, 6, 8, 9, 10],
    "RW": [2, 4, 6, 8, 9],
    "SA": [2, 3, 4, 5, 6, 7, 8, 9, 10, 11],
    "SB": [2, 4, 6, 8, 10],
    "SC": [2, 4, 6, 8, 10],
    "SD": [2, 4, 5, 6, 8, 9, 10, 11],
    "SE": [4, 7],
    "SG": [6, 11],
    "SH": [2, 3, 4, 10],
    "SI": [8, 10],
    "SK": [4, 6, 8, 9],
    "SL": [2, 4, 5, 6, 7, 8, 10],
    "SN": [2, 4, 5, 6, 7, 8, 9, 10],
    "SO": [2, 3, 4, 5, 6, 9],
    "SR": [4, 6],
    "SS": [4, 5, 6, 7, 8],
    "ST": [2, 4, 6, 7],
    "SV": [4, 5, 6, 7, 8, 9, 10],
    "SY": [2, 4, 5, 6, 7, 8, 10],
    "SZ": [2, 4, 6, 10],
    "TD": [2, 4, 6, 7, 8, 9, 10],
    "TG": [2, 4, 6, 8, 9, 10],
    "TH": [4, 6, 8, 10],
    "TJ": [2, 4, 5, 6, 7, 8, 10],
    "TK": [2, 4, 6, 8, 10],
    "TL": [2, 4, 5, 6],
    "TM": [4, 5, 6, 7, 8, 9, 10, 11],
    "TN": [2, 4, 5, 6, 8],
    "TO": [2, 4, 6, 8, 10],
    "TR": [4, 6],
    "TV": [2, 4, 6, 8, 10],
    "TW": [4, 7, 8],
    "TZ": [3, 4, 5, 6, 7, 8, 9, 10],
    "UA": [4, 6, 7, 8, 9, 10],
    "UG": [2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12],
    "US": [4, 6, 8],
    "UY": [4, 8, 10],
    "UZ": [2, 3, 4, 5, 6, 7, 8, 10],
    "VE": [4, 6, 7, 8, 9, 10],
    "VN": [4, 6],
    "VU": [2, 4, 6, 8, 10],
    "WF": [2, 4, 6, 8, 10],
    "WS": [2, 4, 6, 8, 10],
    "XK": [5, 6, 8, 9, 10],
    "YE": [2, 4, 5, 6, 7],
    "ZA": [1, 2, 4, 6, 8, 9, 10, 11],
    "ZM": [2, 4, 5, 6, 9],
    "ZW": [2, 4, 6, 8, 10],
}

# By country code, alternative sets of levels; a shape that holds all of one set is ok, any other partial.  Countries that are
# not named take their first level alone.
ALTERNATIVES = {
    "AL": [[4, 6], [4, 7], [4, 8]],
    "AR": [[4, 5, 8]],
    "AT": [[4, 6], [4, 8]],
    "BE": [[4, 6], [4, 8]],
    "BO": [[4, 6, 8]],
    "BR": [[4, 8]],
    "CA": [[4], [5], [6], [7], [8]],
    "CH": [[4, 6], [4, 8]],
    "CL": [[4, 6, 8]],
    "CN": [[4], [5], [6]],
    "CO": [[4, 6]],
    "CZ": [[4, 6], [4, 7], [4, 8]],
    "DE": [[4, 6], [4, 8]],
    "DK": [[4, 7]],
    "EC": [[4, 6, 8]],
    "ES": [[4, 6], [4, 8]],
    "FI": [[4, 8]],
    "FR": [[4, 6], [4, 8]],
    "GB": [[4, 6], [4, 7]],
    "GY": [[4, 6, 8]],
    "ID": [[4, 5], [4, 6], [4, 7]],
    "IE": [[5, 6, 7, 8, 9]],
    "IN": [[4, 5, 6]],
    "IS": [[5, 6]],
    "IT": [[4, 6], [4, 8]],
    "JM": [[5], [6]],
    "JP": [[3, 4], [3, 7]],
    "KE": [[2]],
    "KG": [[4]],
    "KH": [[2]],
    "KP": [[4]],
    "KR": [[4, 6], [4, 8]],
    "LU": [[6, 8]],
    "MX": [[4, 6]],
    "MY": [[4, 5], [4, 6], [4, 7], [4, 8], [4, 10]],
    "NL": [[4, 8]],
    "NO": [[4, 7]],
    "NZ": [[4, 6], [6, 8]],
    "PE": [[4, 6, 8]],
    "PH": [[4, 6, 10]],
    "PL": [[4, 6], [4, 7]],
    "PS": [[4]],
    "SE": [[4, 7]],
    "SG": [[6, 11]],
    "TH": [[4, 6], [4, 8], [4, 10]],
    "TR": [[4, 6]],
    "US": [[4, 6], [4, 8]],
    "UZ": [[4]],
    "VN": [[4, 6]],
    "ZA": [[2]],
}

# Countries whose shapes are listed one by one, as (ok, partial); no other shape is allowed there.
LISTED_SHAPES = {
    "AU": ("4-6 4-7", "4 6 7 6-7 4-6-7"),
    "GR": (
        "3 4-5 4-5-6 4-5-6-7 4-5-6-7-8 4-5-6-8 4-5-7 4-5-7-8 4-6 4-6-7 4-6-7-8 4-6-8 4-7 4-7-8 5-6 5-6-7 5-6-7-8 5-6-8 5-7 5-7-8 6-7 6-7-8",
        "4 4-5-8 4-8 5 5-8 6 6-8 7 7-8 8",
    ),
    "PT": ("4-7 4-7-8 6-7 6-7-8", "4 4-8 6 6-8 7 7-8 8"),
    "TW": ("4 4-7 4-8 4-7-8", ""),
}

# Tolerance in degrees by level; deeper levels take the last one.
TOLERANCE = {1: 0.01, 2: 0.01, 3: 0.01, 4: 0.01, 5: 0.002, 6: 0.001}
NEARBY_KM, OFFSHORE_KM = 2.0, 20.0

PROFILE = "country string, levels array<int>, name_keys array<string>, languages array<string>"


def level_table(spark: SparkSession) -> DataFrame:
    """``country, levels``."""
    return spark.createDataFrame([(code.lower(), levels) for code, levels in LEVELS.items()], "country string, levels array<int>")


def shape_alternatives(spark: SparkSession) -> DataFrame:
    """``country, alternatives`` of the countries whose rule is not their first level."""
    return spark.createDataFrame([(code.lower(), sets) for code, sets in ALTERNATIVES.items()], "country string, alternatives array<array<int>>")


def listed_shapes(spark: SparkSession) -> DataFrame:
    """``country, shape, status`` of the countries that list their shapes."""
    rows = [(code.lower(), shape, status) for code, both in LISTED_SHAPES.items() for status, shapes in zip(("ok", "partial"), both) for shape in shapes.split()]
    return spark.createDataFrame(rows, "country string, shape string, status string")


def default_profiles(levels: DataFrame, languages: DataFrame | None = None) -> DataFrame:
    """Profiles by rule: the English name first, then the plain, official and local ones; ``languages(country, languages)`` overrides."""
    rows = levels.withColumn("own", F.array(F.lit("en"), F.col("country")))
    if languages is not None:
        rows = rows.join(F.broadcast(languages), "country", "left").withColumn("own", F.coalesce("languages", "own")).drop("languages")
    local = F.transform(F.array_except("own", F.array(F.lit("en"))), lambda x: F.concat(F.lit("name:"), x))
    return rows.select("country", "levels", F.concat(F.array(F.lit("name:en"), F.lit("name"), F.lit("official_name")), local).alias("name_keys"), F.col("own").alias("languages"))


def level_policies(levels: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """``country, level, tolerance``: by rule, or as ``overrides`` of the same schema say."""
    deepest = TOLERANCE[max(TOLERANCE)]
    known = F.create_map(*(F.lit(x) for kv in TOLERANCE.items() for x in kv))
    rows = levels.select("country", F.explode("levels").alias("level")).withColumn("tolerance", F.coalesce(F.try_element_at(known, F.col("level")), F.lit(deepest)))
    if overrides is None:
        return rows
    special = overrides.withColumnRenamed("tolerance", "special").withColumn("listed", F.lit(True))
    joined = rows.join(F.broadcast(special), ["country", "level"], "left")
    return joined.select("country", "level", F.when(F.col("listed"), F.col("special")).otherwise(F.col("tolerance")).alias("tolerance"))


def nearby_policy(levels: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """``country, nearby_km, offshore_km``."""
    rows = levels.select("country")
    if overrides is None:
        return rows.select("country", F.lit(NEARBY_KM).alias("nearby_km"), F.lit(OFFSHORE_KM).alias("offshore_km"))
    joined = rows.join(F.broadcast(overrides), "country", "left")
    return joined.select("country", F.coalesce("nearby_km", F.lit(NEARBY_KM)).alias("nearby_km"), F.coalesce("offshore_km", F.lit(OFFSHORE_KM)).alias("offshore_km"))
