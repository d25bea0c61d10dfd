"""Names and tags: first non-empty name, aliases by language, levels, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Labels of the common levels.
LEVEL_LABELS = {
    2: "admin_country",
    3: "admin_region",
    4: "admin_region",
    5: "admin_district",
    6: "admin_municipality",
    7: "admin_locality",
    8: "admin_locality",
    9: "admin_locality",
    10: "admin_detail",
}


def trimmed(value: Column) -> Column:
    """Text without white space at either end; null if nothing is left."""
    return F.nullif(F.regexp_replace(value, r"^\s+|\s+$", ""), F.lit(""))


def pick_name(tags: Column, keys: list[str] | Column) -> Column:
    """The value of the first key whose value is not empty, else null. ``keys`` may be a profile's array column."""
    if isinstance(keys, list):
        return F.coalesce(*(F.nullif(F.try_element_at(tags, F.lit(k)), F.lit("")) for k in keys))
    values = F.transform(keys, lambda k: F.try_element_at(tags, k))
    return F.try_element_at(F.filter(values, lambda v: v != ""), F.lit(1))


def level_of(text: Column) -> Column:
    """A level if the text is ASCII digits only, else null."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))


def level_label(level: Column, labels: dict[int, str] | None = None) -> Column:
    named = F.create_map(*(F.lit(x) for kv in (labels or LEVEL_LABELS).items() for x in kv))
    return F.coalesce(F.try_element_at(named, level), F.concat(F.lit("admin_level_"), level.cast("string")))


def country_code(text: Column) -> Column:
    """Lower-case code without white space of any kind around it; ``uk`` is ``gb``; an empty code or none is an error."""
    code = F.lower(F.coalesce(F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""), F.lit("")))
    return F.when(code == "", F.raise_error(F.lit("empty country code")).cast("string")).when(code == "uk", "gb").otherwise(code)


def runtime_id(feature_id: Column, iso: Column | str) -> Column:
    """The id without its ``<iso>_`` prefix; null passes."""
    iso = F.lit(iso) if isinstance(iso, str) else iso
    return F.when(F.startswith(feature_id, F.concat(iso, F.lit("_"))), F.substring(feature_id, F.length(iso) + 2, F.length(feature_id))).otherwise(feature_id)


def feature_id(relation: Column, country: Column | str | None = None) -> Column:
    """``<country>_r<relation>`` in lower case; ``adm`` stands for a country that is not known."""
    code = F.lit(country) if country is None or isinstance(country, str) else country
    return F.concat(F.lower(F.coalesce(F.nullif(code.cast("string"), F.lit("")), F.lit("adm"))), F.lit("_r"), relation.cast("string"))


def node_label(name: Column, level: Column, node_id: Column) -> Column:
    """``name [level=n] [id=..]`` with what is known."""
    shown = F.coalesce(F.nullif(name, F.lit("")), F.lit("(unnamed)"))
    return F.concat_ws(" ", shown, F.concat(F.lit("[level="), level.cast("string"), F.lit("]")), F.concat(F.lit("[id="), node_id, F.lit("]")))


def alias_names(tags: Column, languages: list[str], extra: list[tuple[str, str]] | None = None) -> Column:
    """Map of language to alias.

    Two-letter ``name:xx`` tags count always, other ``name:<x>`` tags if ``x`` is a listed language whatever its case, spelled as listed; then the
    extra (tag, language) pairs.  In order of language and tag, a language or a text already used is dropped.  Null if none is left.
    """
    listed = F.create_map(*(F.lit(x) for lang in languages for x in (lang.lower(), lang))) if languages else F.create_map().cast("map<string,string>")
    entries = F.array_sort(F.map_entries(F.map_filter(tags, lambda k, v: F.startswith(k, F.lit("name:")))))
    tagged = F.transform(
        entries,
        lambda e, i: F.struct(
            F.when(F.substring(e["key"], 6, 99).rlike("^[A-Za-z]{2}$"), F.lower(F.substring(e["key"], 6, 99)))
            .otherwise(F.try_element_at(listed, F.lower(F.substring(e["key"], 6, 999))))
            .alias("lang"),
            i.alias("at"),
            trimmed(e["value"]).alias("name"),
        ),
    )
    more = F.array(*(F.struct(F.lit(lang).alias("lang"), F.lit(100_000 + k).alias("at"), trimmed(F.try_element_at(tags, F.lit(tag))).alias("name")) for k, (tag, lang) in enumerate(extra or [])))
    every = F.concat(tagged, more) if extra else tagged
    usable = F.array_sort(F.filter(every, lambda c: c["lang"].isNotNull() & c["name"].isNotNull()))
    start = F.array().cast("array<struct<lang:string,at:int,name:string>>")
    kept = F.aggregate(usable, start, lambda seen, c: F.when(F.exists(seen, lambda s: (s["lang"] == c["lang"]) | (s["name"] == c["name"])), seen).otherwise(F.concat(seen, F.array(c))))
    names = F.map_from_entries(F.transform(kept, lambda c: F.struct(c["lang"], c["name"])))
    return F.when(F.size(kept) > 0, names)


def alias_counts(relations: DataFrame, keys: Column) -> DataFrame:
    """``lang, n``: how often each ``name:`` language of two characters or with a dash occurs, in lower case."""
    lang = F.lower(F.regexp_extract("k", r"(?s)^name:(..|.*-.*)$", 1))
    return relations.select(F.explode(keys).alias("k")).select(lang.alias("lang")).filter("lang <> ''").groupBy("lang").agg(F.count("*").alias("n"))


def alias_policy(counts: DataFrame, least_share: float = 0.1, most: int = 5) -> DataFrame:
    """Languages at ``least_share`` of the most frequent one at least, the ``most`` first by count and name, with their rank."""
    top = counts.agg(F.max("n").alias("top"))  # one row
    first = counts.withColumn("__one", F.lit(1)).join(F.broadcast(top.withColumn("__one", F.lit(1))), "__one")
    first = first.filter(F.col("n") >= least_share * F.col("top")).select("lang", "n").orderBy(F.desc("n"), "lang").limit(most)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy().orderBy(F.desc("n"), "lang")))  # over ``most`` rows
