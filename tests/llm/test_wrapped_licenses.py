import textwrap

from limes.llm import licenses
from tests.oracle import duck, spark_rows


def wrapped(text, width):
    return "\n".join(textwrap.fill(line, width) for line in text.split("\n"))


def test_known_texts_are_found_in_any_wrapping(spark):
    whole = [(i, s) for i, (i_, kind, s) in enumerate(licenses.KNOWN) if kind == "text"]
    rows = [(100 * i + w, "Copyright (c) 2020 Some Body\n\n" + wrapped(s, w)) for i, s in whole for w in range(70, 81)]
    rows += [(100 * i + 99, s.replace("copyright notice", "\ncopyright notice").replace("COPYRIGHT HOLDER", "\r\n * COPYRIGHT\r\n * HOLDER")) for i, s in whole]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in licenses.scan(df, licenses.known_digests(spark)).filter("line_no = 0").collect()}
    assert got == {i: licenses.KNOWN[i // 100][0] for i, _ in rows}


def test_notices_are_dropped(spark):
    notices = ["Copyright (c) 2020 Some Body", "copyright 1999-2001, the authors", " * Copyright \u00a9 2020 X", "Copyright The Foundation", "Copyright: \u0420\u043e\u043c\u0430\u0448\u043a\u0430", "# COPYRIGHT BY SOMEBODY"]
    df = spark.createDataFrame([(i, n + "\n" + licenses.MIT) for i, n in enumerate(notices)], "doc_id long, text string")
    assert {r.license_id for r in licenses.scan(df, licenses.known_digests(spark)).collect()} == {"MIT"}


def test_statement_drops_the_same_lines(spark, tmp_path):
    """Whole licenses in any wrapping, and lines that begin with the word in many ways."""
    begins = ["", " * ", "# ", "//\t", "- x "]
    goes_on = ["", " ", " notice", ", holders and", " noticeboard", "ed by", " (c) 2020 x", ": or", "\r", "'*\" in part", " \u00a9 2020", "s", " the authors", "; 1999 law", " interest.", " interests", " and", " andrew"]
    rows = [(i, f"first\n{b}Copyright{g}\n{licenses.MIT}") for i, (b, g) in enumerate((b, g) for b in begins for g in goes_on)]
    rows += [(1_000 + i, f"{b}COPYRIGHT{g}") for i, (b, g) in enumerate((b, g) for b in begins for g in goes_on)]
    texts = [t for _, kind, t in licenses.KNOWN if kind == "text"]
    rows += [(10_000 + 100 * i + w, "Copyright (c) 2020 Some Body\n\n" + wrapped(t, w)) for i, t in enumerate(texts) for w in range(70, 81)]
    rows += [(20_000 + i, t.replace("copyright notice", "\ncopyright notice").replace("COPYRIGHT HOLDER", "\r\n * COPYRIGHT\r\n * HOLDER")) for i, t in enumerate(texts)]
    rows += [(30_000, None), (30_001, ""), (None, "Licensed under the MIT License.\nCopyright\n")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "made"))
    next((tmp_path / "made").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    got = spark_rows(licenses.op6_licenses(spark, str(tmp_path)))
    assert got == duck(licenses.ORACLE, str(tmp_path))
    at = got[0].index("doc_id"), got[0].index("license_id")
    found = {r[at[0]] for r in got[1] if r[at[1]] is not None and r[at[0]] is not None}
    assert {i for i, _ in rows if i is not None and 10_000 <= i < 30_000} <= found
