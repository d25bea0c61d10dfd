"""Arithmetic, digests and level sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 65_535


def round_half_up(value: Column) -> Column:
    return F.floor(value + F.lit(0.5))


def quantize(value: Column, low: Column, span: Column, steps: int = STEPS) -> Column:
    """``value`` on a grid of ``steps`` over [low, low + span], halves up, clamped; 0 where the span is 0."""
    scaled = round_half_up((value - low) * F.lit(float(steps)) / F.nullif(span, F.lit(0)))
    return F.when(span == 0, F.lit(0)).otherwise(F.least(F.greatest(scaled, F.lit(0)), F.lit(steps))).cast("int")


def path_signature(path: Column) -> Column:
    """SHA-256 of the ids joined by U+001F."""
    return F.sha2(F.concat_ws("\x1f", path), 256)


def unwrap_longitude(lon: Column) -> Column:
    return F.when(lon < 0, lon + 360).otherwise(lon)


def wrap_longitude(lon: Column) -> Column:
    return F.when(lon >= 180, lon - 360).otherwise(lon)


def canonical_digest(*columns: str) -> Column:
    """SHA-256 of the columns as JSON with sorted keys, nulls written out."""
    return F.sha2(canonical_json(*columns), 256)


def canonical_json(*columns: str) -> Column:
    """The columns as JSON with sorted keys, nulls written out."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def list_digest(rows: DataFrame, group: str, line: Column, name: str, stamp: str | None = None, form: tuple[str, str, str] = ("", "\n", "")) -> DataFrame:
    """SHA-256 of each group's lines, sorted and joined; with ``stamp`` also its ``latest`` and ``n_files``.

    ``form`` is what stands before, between and after lines: newlines, or ``("[", ",", "]")`` for a list in JSON.

    The lines are sorted on disk and stream through the digest, so no list is held, however long it is.  One list is one task's, since the
    digest of a whole is not made of digests of its parts.
    """
    listed = rows.select(F.col(group).alias("g"), line.alias("line"), *([F.col(stamp).alias("latest")] if stamp else []))
    kind = {f.name: f.dataType.simpleString() for f in listed.schema.fields}
    columns = [("g", kind["g"]), ("digest", "string")] + ([("latest", kind["latest"]), ("n_files", "long")] if stamp else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None  # group, digest, latest, lines so far
        for batch in batches:
            keys, lines = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if now is None or now[0] != keys[lo]:
                    if now:
                        yield done(now, batch.schema)
                    now = [keys[lo], hashlib.sha256(form[0].encode()), None, 0]
                now[1].update(((form[1] if now[3] else "") + form[1].join(lines[lo:hi])).encode())
                now[3] += hi - lo
                if stamp:
                    now[2] = max((x for x in (now[2], *batch.column(2)[lo:hi].to_pylist()) if x is not None), default=None)
                schema = batch.schema
        if now:
            yield done(now, schema)

    def done(now: list, schema: pa.Schema) -> pa.RecordBatch:
        now[1].update(form[2].encode())
        values = [pa.array([now[0]], schema.field(0).type), pa.array([now[1].hexdigest()])]
        if stamp:
            values += [pa.array([now[2]], schema.field(2).type), pa.array([now[3]], pa.int64())]
        return pa.RecordBatch.from_arrays(values, names=[c for c, _ in columns])

    out = listed.repartition("g").sortWithinPartitions("g", "line").mapInArrow(run, ", ".join(f"{c} {t}" for c, t in columns))
    return out.select(F.col("g").alias(group), F.col("digest").alias(name), *(["latest", "n_files"] if stamp else []))
