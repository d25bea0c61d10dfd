"""URL filters by dated lists: entries become validity intervals, captures meet the ones active at their fetch time.

An entry says that from ``since`` on a domain is to be blocked, allowed or no longer listed.  Successive entries of a domain
close each other's interval, so at any time a domain has at most one active entry.  A capture is judged by the active entry of the
longest listed suffix of its host.

Distinct hosts are looked up first: each host's suffixes are hash-joined with the list, giving one row a listed host with the
intervals that can apply.  That table is written, so Spark knows its size: below ``spark.sql.autoBroadcastJoinThreshold`` captures meet it
where they are, beyond it by host and one of ``SALTS`` parts of captures, so that a host with a third of all captures is spread.  The as-of
test is an array filter.  Only DataFrame functions are used.

Defined results: a null or malformed URL has a null host and is kept with ``verdict`` 'unlisted'; a null fetch time matches no
entry; a null capture id is kept; entries of one domain at one time: the last action by code point holds; repeated captures repeat; empty tables give all
captures unlisted or an empty table; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from limes.llm.common import table, written

SALTS = 32
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
#: Production list: (domain, since, action). 'drop' takes the domain off the list.
LIST: list[tuple[str, str, str]] = [
    ("casino-win.example.com", "2024-01-15", "block"),
    ("casino-win.example.com", "2024-06-01", "drop"),
    ("casino-win.example.com", "2024-09-10", "block"),
    ("free-bets.example.com", "2024-02-01", "block"),
    ("free-bets.example.net", "2024-03-20", "block"),
    ("free-bets.example.org", "2024-03-20", "block"),
    ("free-bets.example.net", "2024-10-05", "allow"),
    ("ads-track.example.com", "2024-01-01", "block"),
    ("ads-track.example.net", "2024-05-05", "block"),
    ("spam-farm.example.com", "2024-04-01", "block"),
    ("spam-farm.example.com", "2024-04-21", "drop"),
    ("spam-farm.example.org", "2024-07-07", "block"),
    ("cheap-pills.example.com", "2024-02-29", "block"),
    ("cheap-pills.example.net", "2024-08-01", "block"),
    ("adult-x.example.net", "2024-01-01", "block"),
    ("adult-x.example.com", "2024-11-11", "block"),
    ("example.org", "2024-12-01", "block"),
    ("ththin.example.org", "2024-12-10", "allow"),
    ("tionsh.example.net", "2024-06-15", "allow"),
]


def intervals(entries: DataFrame) -> DataFrame:
    """``domain, action, since, until``: each entry holds until the domain's next one (null: for ever)."""
    once = entries.groupBy("domain", "since").agg(F.max("action").alias("action"))
    following = F.lead("since").over(Window.partitionBy("domain").orderBy("since"))
    return once.withColumn("until", following).filter("action <> 'drop'")


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures(capture_id, url, fetched date)`` with host, the deciding entry and the verdict."""
    seen = captures.select("capture_id", "fetched", F.nullif(F.regexp_extract(F.lower("url"), HOST, 1), F.lit("")).alias("host"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keyed = seen.select("host").filter("host IS NOT NULL").distinct().select("host", F.explode(suffixes).alias("domain"))
    entry = F.struct(F.length("domain").alias("n"), "domain", "action", "since", "until")
    per_host = keyed.join(intervals(entries), "domain").groupBy("host").agg(F.collect_list(entry).alias("entries"))
    per_host = written(per_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "listed-hosts")
    seen = seen.withColumn("salt", F.pmod(F.xxhash64("capture_id", "fetched"), F.lit(SALTS)).cast("int"))
    active = F.filter("entries", lambda e: (e["since"] <= F.col("fetched")) & (e["until"].isNull() | (F.col("fetched") < e["until"])))
    best = F.try_element_at(F.sort_array(active, asc=False), F.lit(1))
    return (
        seen.join(per_host, ["host", "salt"], "left")
        .withColumn("best", best)
        .select(
            "capture_id",
            "host",
            "fetched",
            F.col("best.domain").alias("matched_domain"),
            F.col("best.since").alias("listed_since"),
            F.coalesce(F.col("best.action"), F.lit("unlisted")).alias("verdict"),
        )
    )


def list_entries(spark, rows: list[tuple[str, str, str]] = LIST) -> DataFrame:
    return spark.createDataFrame(rows, "domain string, since string, action string").withColumn("since", F.to_date("since"))


def op8_url_filters(spark, sf_dir: str) -> DataFrame:
    """All pages; the table has no fetch time, so a page's is 2024-01-01 plus its id modulo 366 days."""
    pages = table(spark, sf_dir, "pages")
    captures = pages.select(F.col("page_id").alias("capture_id"), "url", F.expr("date_add(DATE'2024-01-01', cast(page_id % 366 AS int))").alias("fetched"))
    return judged(captures, list_entries(spark)).withColumnRenamed("capture_id", "page_id")


ORACLE = f"""
WITH entries AS (SELECT domain, since::DATE AS since, max(action) AS action FROM (VALUES {', '.join(str(x) for x in LIST)}) v(domain, since, action) GROUP BY 1, 2),
active AS (SELECT * FROM (SELECT *, lead(since) OVER (PARTITION BY domain ORDER BY since) AS until FROM entries) WHERE action <> 'drop'),
seen AS (SELECT page_id, nullif(regexp_extract(lower(url), '{HOST}', 1), '') AS host, DATE '2024-01-01' + (page_id % 366)::INT AS fetched FROM pages),
hits AS (
  SELECT s.page_id, a.domain, a.since, a.action, row_number() OVER (PARTITION BY s.page_id ORDER BY length(a.domain) DESC) AS rn
  FROM seen s JOIN active a ON s.host = a.domain OR s.host LIKE '%.' || a.domain
  WHERE a.since <= s.fetched AND (a.until IS NULL OR s.fetched < a.until))
SELECT s.page_id, s.host, s.fetched, h.domain AS matched_domain, h.since AS listed_since, coalesce(h.action, 'unlisted') AS verdict
FROM seen s LEFT JOIN hits h ON s.page_id = h.page_id AND h.rn = 1
"""
