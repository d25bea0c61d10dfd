"""Rings from segments: closed outlines, their nesting, relations' polygons, dissolved features and cuts at the antimeridian.

Segments of a group (a relation, a region, a feature) are walked by turning as far as possible to one side at every vertex, so rings that touch
at a vertex come out apart.  A segment that occurs an even number of times is inside the union and drops out before the walk.

Groups stream through sorted partitions one after the other, so a task holds one at a time: the corners of one feature's outline or the ways
of one relation, whatever the size of the table.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from limes.operators.noding import noded
from limes.session import spread

Point = tuple[float, float]
Segment = tuple[Point, Point]


def area(ring: list[Point]) -> float:
    """Signed area, above 0 if the ring turns left."""
    return sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]])) / 2


def holds(ring: list[Point], p: Point) -> bool:
    """Is the point inside, by crossings to its right?"""
    x, y = p
    return sum((ay > y) != (by > y) and ax + (y - ay) * (bx - ax) / (by - ay) > x for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]])) % 2 == 1


def _inner_point(ring: list[Point]) -> Point:
    """A point inside a simple ring: on a line between vertex heights, the middle of the first inner run."""
    ys = sorted({y for _, y in ring})
    y = (ys[(len(ys) - 1) // 2] + ys[(len(ys) - 1) // 2 + 1]) / 2 if len(ys) > 1 else ys[0]
    xs = sorted(ax + (y - ay) * (bx - ax) / (by - ay) for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]) if (ay > y) != (by > y))
    return ((xs[0] + xs[1]) / 2, y) if len(xs) > 1 else ring[0]


def odd_segments(segments: list[Segment]) -> list[Segment]:
    """Segments that occur an odd number of times, smaller end first, in order."""
    odd: set[Segment] = set()
    for a, b in segments:
        if a != b:
            odd ^= {(min(a, b), max(a, b))}
    return sorted(odd)


def faces(segments: list[Segment]) -> list[list[Point]]:
    """Faces of the plane that the segments cut out, as traced: bounded ones turn left, the outside of each connected part turns right.

    Ends that lead nowhere are pruned first.
    """
    around: dict[Point, set[Point]] = {}
    for a, b in segments:
        around.setdefault(a, set()).add(b)
        around.setdefault(b, set()).add(a)
    loose = [v for v, n in around.items() if len(n) == 1]
    while loose:
        v = loose.pop()
        for u in around.pop(v, ()):
            around[u].discard(v)
            if len(around[u]) == 1:
                loose.append(u)
            elif not around[u]:
                del around[u]
    turn: dict[Segment, Point] = {}
    for v, n in around.items():
        order = sorted(n, key=lambda u: math.atan2(u[1] - v[1], u[0] - v[0]))
        for k, u in enumerate(order):
            turn[u, v] = order[k - 1]  # coming from u, the next way clockwise
    out, seen = [], set()
    for step in sorted(turn):
        ring = []
        while step not in seen:
            seen.add(step)
            ring.append(step[0])
            step = (step[1], turn[step])
        if ring:
            out.append(ring)
    return out


#: probes and sides are met pair by pair up to this number of pairs, where arrays cost more than they save
FEW_PAIRS = 1_000


def _below(a: Point, b: Point, p: Point) -> bool:
    """Is the side below the point, as ``holders`` counts it?"""
    (ax, ay), (bx, by) = (a, b) if a[0] <= b[0] else (b, a)
    return ax <= p[0] < bx and (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0


def holders(rings: list[list[Point]], probes: list[Point]) -> list[list[int]]:
    """For each probe the rings that hold it: those with an odd number of sides below it.

    Sides are listed in upright strips, as many as keep the lists short, and a probe meets the sides of its strip only.
    """
    found: list[list[int]] = [[] for _ in probes]
    if not rings or not probes:
        return found
    if len(probes) * sum(len(r) for r in rings) <= FEW_PAIRS:
        return [[k for k, r in enumerate(rings) if sum(_below(a, b, p) for a, b in sides(r)) % 2] for p in probes]
    own = np.repeat(np.arange(len(rings)), [len(r) for r in rings])
    a = np.array([p for r in rings for p in r], dtype=float)
    b = np.array([p for r in rings for p in (*r[1:], r[0])], dtype=float)
    upright = a[:, 0] == b[:, 0]
    own, a, b = own[~upright], a[~upright], b[~upright]
    if not len(a):
        return found
    turned = a[:, 0] > b[:, 0]
    a[turned], b[turned] = b[turned], a[turned]
    at = np.array(probes, dtype=float)
    low, high = float(a[:, 0].min()), float(b[:, 0].max())
    n = max(1, int(len(a) ** 0.5) * 4)
    strip = lambda x: np.clip(((x - low) * (n / (high - low))).astype(np.int64), 0, n - 1)
    while n > 1 and int((strip(b[:, 0]) - strip(a[:, 0]) + 1).sum()) > 8 * len(a) + 1000:
        n //= 2
    first = strip(a[:, 0])
    count = strip(b[:, 0]) - first + 1
    side = np.repeat(np.arange(len(a)), count)
    where = np.arange(len(side)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    order = np.argsort(where, kind="stable")
    side, bound = side[order], np.searchsorted(where[order], np.arange(n + 1))
    of_probe = np.argsort(strip(at[:, 0]), kind="stable")
    probe_bound = np.searchsorted(strip(at[:, 0])[of_probe], np.arange(n + 1))
    for k in np.flatnonzero(np.diff(probe_bound)):
        sides_here = side[bound[k] : bound[k + 1]]
        if not len(sides_here):
            continue
        ax, ay, bx, by = a[sides_here, 0], a[sides_here, 1], b[sides_here, 0], b[sides_here, 1]
        some = of_probe[probe_bound[k] : probe_bound[k + 1]]
        step = max(1, 2_000_000 // len(sides_here))
        for lo in range(0, len(some), step):
            part = some[lo : lo + step]
            x, y = at[part, 0][:, None], at[part, 1][:, None]
            below = (ax <= x) & (bx > x) & ((bx - ax) * (y - ay) - (by - ay) * (x - ax) > 0)
            row, hit = np.nonzero(below)
            key, times = np.unique(row * len(rings) + own[sides_here[hit]], return_counts=True)
            for j in key[times % 2 == 1].tolist():
                found[int(part[j // len(rings)])].append(j % len(rings))
    return found


def nested(rings: list[list[Point]]) -> list[list[int]]:
    """For each of some rings that do not cross the larger ones that hold it."""
    if len(rings) == 1:
        return [[]]
    sizes = [abs(area(r)) for r in rings]
    return [[o for o in held if sizes[o] > sizes[k]] for k, held in enumerate(holders(rings, [_inner_point(r) for r in rings]))]


def _simple(ring: list[Point]) -> Iterator[list[Point]]:
    """A traced face cut at vertices that it passes more than once."""
    way: list[Point] = []
    at: dict[Point, int] = {}
    for p in ring:
        if p in at:
            k = at[p]
            yield way[k:]
            for q in way[k + 1 :]:
                del at[q]
            del way[k + 1 :]
        else:
            at[p] = len(way)
            way.append(p)
    yield way


def outline(segments: list[Segment]) -> list[list[Point]]:
    """Outer rings of the union of all that the segments enclose, turning left, none inside another."""
    rings = []
    for face in faces(sorted({(min(a, b), max(a, b)) for a, b in segments if a != b})):
        if area(face) < 0:
            rings += [r[::-1] for r in _simple(face) if len(r) > 2 and area(r) < 0]
    return [r for r, held in zip(rings, nested(rings)) if not held]


def parity_rings(segments: list[Segment]) -> list[tuple[list[Point], str]]:
    """Simple rings of the even-odd area of the segments with their roles, largest first; each starts at its smallest corner.

    Rims are peeled off from outside to inside, so every segment is in one ring, and rings that touch are apart.
    """
    rings: list[list[Point]] = []
    left = odd_segments(segments)
    while left:
        rims = [r for face in faces(left) if area(face) < 0 for r in _simple(face) if len(r) > 2]
        if not rims:
            break  # open chains
        rings += [_from_smallest(r[::-1]) for r in rims]
        left = odd_segments(left + [s for r in rims for s in sides(r)])
    rings.sort(key=lambda r: (-abs(area(r)), r[0]))
    return [(r, "inner" if len(held) % 2 else "outer") for r, held in zip(rings, nested(rings))]


def sides(ring: list[Point]) -> list[Segment]:
    return list(zip(ring, [*ring[1:], ring[0]]))


def cut_at_meridian(segments: list[Segment], at: float = 180.0) -> tuple[list[Segment], list[Segment]]:
    """The segments of even-odd rings on either side of a meridian, closed along it."""
    west, east, heights = [], [], []
    for a, b in segments:
        if (a[0] <= at) == (b[0] <= at):
            (west if a[0] <= at else east).append((a, b))
            continue
        a, b = (a, b) if a[0] <= at else (b, a)
        p = (at, a[1] + (b[1] - a[1]) * (at - a[0]) / (b[0] - a[0]))
        heights.append(p[1])
        west.append((a, p))
        east.append((p, b))
    heights.sort()
    closing = [((at, lo), (at, hi)) for lo, hi in zip(heights[::2], heights[1::2]) if lo != hi]
    return west + closing, east + closing


def parts_of(rings: list[tuple[list[Point], str]]) -> list[tuple[int, list[Point], str]]:
    """(part, ring, role): every outer ring is a part, with the inner rings that it is the smallest to hold."""
    outer = [r for r, role in rings if role == "outer"]
    out = [(k, r, "outer") for k, r in enumerate(outer)]
    inner = [r for r, role in rings if role == "inner"]
    for r, held in zip(inner, holders(outer, [_inner_point(r) for r in inner])):
        out.append((max(k for k in held if abs(area(outer[k])) > abs(area(r))), r, "inner"))
    return sorted(out, key=lambda x: (x[0], x[2] != "outer"))


def _from_smallest(ring: list[Point]) -> list[Point]:
    k = ring.index(min(ring))
    return ring[k:] + ring[:k]


def per_group(rows: DataFrame, keys: list[str], order: list[str], schema: str, run: Callable[[tuple, list[tuple]], list[tuple]]) -> DataFrame:
    """``run(key, rows)`` for each group of ``rows``, sorted by ``order``; ``rows`` has the keys first, and none is null."""
    names = [c.split()[0] for c in schema.split(", ")]

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = itertools.chain.from_iterable(f.itertuples(index=False, name=None) for f in frames)
        out: list[tuple] = []
        for key, group in itertools.groupby(every, key=lambda r: r[: len(keys)]):
            out += run(key, [r[len(keys) :] for r in group])
            if len(out) >= 5_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    return spread(rows, *keys).sortWithinPartitions(*keys, *order).mapInPandas(stream, schema)


def _pts(ring: list[Point]) -> list[dict]:
    return [{"x": float(x), "y": float(y)} for x, y in [*ring, ring[0]]]


RING = "part int, ring int, role string, pts array<struct<x:double,y:double>>"


def outlines(segments: DataFrame, group: str) -> DataFrame:
    """``group, part, ring, role, pts``: the rings of dissolved segments ``group, x1, y1, x2, y2``."""
    kind = segments.schema[group].dataType.simpleString()

    def run(key: tuple, rows: list[tuple]) -> list[tuple]:
        rings = parts_of(parity_rings([((float(a), float(b)), (float(c), float(d))) for a, b, c, d in rows]))
        return [(*key, part, k, role, _pts(r)) for k, (part, r, role) in enumerate(rings)]

    return per_group(segments.select(group, "x1", "y1", "x2", "y2").filter(f"{group} IS NOT NULL"), [group], ["x1", "y1"], f"{group} {kind}, {RING}", run)


def split_at_antimeridian(edges: DataFrame) -> DataFrame:
    """``feature_id, part, ring, role, pts`` of ``feature_id, x1, y1, x2, y2``.

    Features that reach both below -120 and above 120 degrees are unwrapped, cut at 180 and shifted back; any number of parts may come of it.
    """
    kind = edges.schema["feature_id"].dataType.simpleString()

    def run(key: tuple, rows: list[tuple]) -> list[tuple]:
        segments = [((float(a), float(b)), (float(c), float(d))) for a, b, c, d in rows]
        return [(*key, part, k, role, _pts(r)) for k, (part, r, role) in enumerate(_unwrapped(segments))]

    return per_group(edges.select("feature_id", "x1", "y1", "x2", "y2"), ["feature_id"], ["x1", "y1"], f"feature_id {kind}, {RING}", run)


def _crosses(xs: list[float]) -> bool:
    return bool(xs) and min(xs) < -120 and max(xs) > 120


def _unwrapped(segments: list[Segment]) -> list[tuple[int, list[Point], str]]:
    if not _crosses([p[0] for s in segments for p in s]):
        return parts_of(parity_rings(segments))
    ahead = lambda p: (p[0] + 360 if p[0] < 0 else p[0], p[1])
    west, east = cut_at_meridian([(ahead(a), ahead(b)) for a, b in segments])
    back = [([(x - 360, y) for x, y in r], role) for r, role in parity_rings(east)]
    first = parts_of(parity_rings(west))
    n = 1 + max((part for part, _, _ in first), default=-1)
    return first + [(part + n, r, role) for part, r, role in parts_of(back)]


POLYGON = f"rel long, {RING}, reason string, outer_lines int, inner_lines int, dangling int, repaired boolean, gap double, unwrapped boolean"


def _closed_over(gap: Segment, segments: list[Segment]) -> list[Segment]:
    """The segments and one more, all cut where that one crosses or touches the others."""
    (ax, ay), (bx, by) = gap
    p, q = np.array([s[0] for s in segments]), np.array([s[1] for s in segments])
    turn = lambda ux, uy, vx, vy, wx, wy: (vx - ux) * (wy - uy) - (vy - uy) * (wx - ux)
    of_p, of_q = turn(ax, ay, bx, by, p[:, 0], p[:, 1]), turn(ax, ay, bx, by, q[:, 0], q[:, 1])
    of_a, of_b = turn(p[:, 0], p[:, 1], q[:, 0], q[:, 1], ax, ay), turn(p[:, 0], p[:, 1], q[:, 0], q[:, 1], bx, by)
    inside = lambda x, y: (x >= min(ax, bx)) & (x <= max(ax, bx)) & (y >= min(ay, by)) & (y <= max(ay, by))
    out, cuts = [], {gap[0], gap[1]}
    for k in np.flatnonzero((of_p == 0) & inside(p[:, 0], p[:, 1])):
        cuts.add(segments[k][0])
    for k in np.flatnonzero((of_q == 0) & inside(q[:, 0], q[:, 1])):
        cuts.add(segments[k][1])
    cross = (np.sign(of_p) * np.sign(of_q) < 0) & (np.sign(of_a) * np.sign(of_b) < 0)
    for k, s in enumerate(segments):
        if cross[k]:
            t = of_p[k] / (of_p[k] - of_q[k])
            at = (float(s[0][0] + (s[1][0] - s[0][0]) * t), float(s[0][1] + (s[1][1] - s[0][1]) * t))
            cuts.add(at)
            out += [(s[0], at), (at, s[1])]
        else:
            out.append(s)
    line = sorted(cuts, key=lambda c: (c[0] - ax) ** 2 + (c[1] - ay) ** 2)
    return out + list(zip(line, line[1:]))


def difference(outer: list[list[Point]], inner: list[list[Point]]) -> list[Segment]:
    """Border of what rings of ``outer`` hold and rings of ``inner`` do not; they meet at corners only, and none is inside another of its kind.

    Rings that touch nothing of the other kind are in or out as a whole; else every side has the area on one of its sides only.
    """
    corners = {p for r in outer for p in r}
    if not any(p in corners for r in inner for p in r):
        held = holders(outer, [_inner_point(r) for r in inner])
        kept = [r for r, h in zip(inner, held) if any(abs(area(outer[k])) > abs(area(r)) for k in h)]
        swallowed = holders(inner, [_inner_point(r) for r in outer])
        whole = [r for r, h in zip(outer, swallowed) if not any(abs(area(inner[k])) > abs(area(r)) for k in h)]
        return odd_segments([s for r in whole + kept for s in sides(r)])
    every = sorted({(min(a, b), max(a, b)) for r in outer + inner for a, b in sides(r)})
    probes = []
    for (ax, ay), (bx, by) in every:
        x, y, dx, dy = (ax + bx) / 2, (ay + by) / 2, (bx - ax) * 1e-6, (by - ay) * 1e-6
        probes += [(x - dy, y + dx), (x + dy, y - dx)]
    there = [bool(o) and not i for o, i in zip(holders(outer, probes), holders(inner, probes))]
    return [s for s, left, right in zip(every, there[::2], there[1::2]) if left != right]


def relation_polygons(members: DataFrame, most_gap: float = 1.0) -> DataFrame:
    """Polygons of ``rel, role, ref, pts``: one row for each ring, or one with a reason.

    Roles are outer, inner or null (not used); ``pts`` is null for a way that is missing or lacks nodes.  Lines are cut where they meet.  Outer
    lines are closed over one gap of ``most_gap`` at most; what they enclose less what inner lines enclose is the polygon.  Reasons are
    ``outer_polygonize_failed`` if outer lines enclose nothing, ``empty_geometry`` if nothing is left, ``non_polygon_geometry`` if what is left has no area.
    """

    def run(key: tuple, rows: list[tuple]) -> list[tuple]:
        lines = {role: [[(float(p["x"]), float(p["y"])) for p in pts] for r, _, pts in rows if r == role and pts is not None and len(pts) > 1] for role in ("outer", "inner")}
        unwrapped = _crosses([x for w in lines.values() for line in w for x, _ in line])
        if unwrapped:
            lines = {role: [[(x + 360 if x < 0 else x, y) for x, y in line] for line in w] for role, w in lines.items()}
        segments = {role: [s for line in w for s in zip(line, line[1:])] for role, w in lines.items()}
        rounded = lambda p: (round(p[0], 9), round(p[1], 9))
        ends = Counter(rounded(p) for line in lines["outer"] for p in (line[0], line[-1]))
        odd = sorted(p for p, n in ends.items() if n % 2)
        gap = math.dist(*odd) if len(odd) == 2 else None
        repaired = gap is not None and gap <= most_gap
        if repaired:
            exact = {rounded(p): p for line in lines["outer"] for p in (line[0], line[-1])}
            segments["outer"] = _closed_over((exact[odd[0]], exact[odd[1]]), segments["outer"])
        told = (len(lines["outer"]), len(lines["inner"]), len(odd), repaired, gap, unwrapped)
        failed = lambda reason: [(*key, None, None, None, None, reason, *told)]
        outer = outline(segments["outer"])
        if not outer:
            return failed("outer_polygonize_failed")
        border = difference(outer, outline(segments["inner"]))
        if not border:
            return failed("empty_geometry")
        if unwrapped:
            ahead = [((x - 360 if x > 180 else x, y), (u - 360 if u > 180 else u, v)) for (x, y), (u, v) in border]
            rings = _unwrapped(ahead)
        else:
            rings = parts_of(parity_rings(border))
        if not sum(abs(area(r)) for _, r, _ in rings):
            return failed("non_polygon_geometry")
        return [(*key, part, k, role, _pts(r), None, *told) for k, (part, r, role) in enumerate(rings)]

    return per_group(noded(members).filter("rel IS NOT NULL"), ["rel"], ["role", "ref"], POLYGON, run)
