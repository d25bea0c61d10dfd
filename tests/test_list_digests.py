import hashlib

from limes.operators import quality
from limes.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_digests_of_lists_longer_than_a_batch_hold_no_list(spark):
    rows = [(s, f"doc/{i}", f"{i * 7 % 1009:x}é", i if i % 3 else None) for s, n in (("a", 1), ("b", 25_000), ("", 3), (None, 12_000)) for i in range(n)]
    files = spark.createDataFrame(rows, "source string, path string, sha256 string, stamp long").repartition(5)
    got = quality.source_identity(files, "source")
    assert "collect_list" not in plan(got)
    want = {}
    for s in ("a", "b", "", None):
        own = [r for r in rows if r[0] == s]
        want[s] = (hashlib.sha256("\n".join(sorted(f"{r[1]}={r[2]}" for r in own)).encode()).hexdigest(), max((r[3] for r in own if r[3] is not None), default=None), len(own))
    assert {r.source: (r.composite, r.latest, r.n_files) for r in got.collect()} == want
    listing = files.selectExpr("source", "path AS name", "stamp AS size", "sha256 AS mtime")
    keys = tables.stage_key(listing, "source")
    assert "collect_list" not in plan(keys)
    lines = lambda s: sorted("|".join(str(x) for x in (r[1], r[3], r[2]) if x is not None) for r in rows if r[0] == s)
    assert {r.source: r.stage_key for r in keys.collect()} == {s: hashlib.sha256("\n".join(lines(s)).encode()).hexdigest() for s in want}
    assert quality.source_identity(files.filter("false"), "source").count() == 0
