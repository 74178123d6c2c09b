"""Plane geometry of one parcel in numpy: covered area, lengths near lines, distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

Ring = np.ndarray  # [n, 2]; the last point may repeat the first


def edges(rings: list[Ring]) -> np.ndarray:
    """[m, 4] segments x1, y1, x2, y2 of closed rings."""
    out = [np.hstack([r, np.roll(r, -1, axis=0)]) for r in rings if len(r)]
    e = np.concatenate(out) if out else np.zeros((0, 4))
    return e[(e[:, :2] != e[:, 2:]).any(axis=1)]


def _crossings(e: np.ndarray) -> np.ndarray:
    """x of all places where two edges cross."""
    p, d = e[:, :2], e[:, 2:] - e[:, :2]
    den = d[:, None, 0] * d[None, :, 1] - d[:, None, 1] * d[None, :, 0]
    gap = p[None] - p[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (gap[..., 0] * d[None, :, 1] - gap[..., 1] * d[None, :, 0]) / den
        u = (gap[..., 0] * d[:, None, 1] - gap[..., 1] * d[:, None, 0]) / den
    i, j = np.nonzero((den != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1))
    return p[i, 0] + t[i, j] * d[i, 0]


def _intervals(e: np.ndarray, x: float) -> list[tuple[float, float]]:
    """Even-odd intervals of y inside the rings at x, which is no vertex."""
    hit = e[(np.minimum(e[:, 0], e[:, 2]) < x) & (np.maximum(e[:, 0], e[:, 2]) > x)]
    y = np.sort(hit[:, 1] + (x - hit[:, 0]) / (hit[:, 2] - hit[:, 0]) * (hit[:, 3] - hit[:, 1]))
    return list(zip(y[::2], y[1::2], strict=False))


def _merged(parts: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for a, b in sorted(parts):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


Box = tuple[float, float, float, float]  # x0, y0, x1, y1


def overlap_areas(parcel: list[Ring], hazards: list[list[Ring]], box: Box | None = None) -> tuple[float, float]:
    """Area of the parcel and the part of it that the union of the hazards covers, both within the box if there is one: areas of boxes side by side add up.

    The plane is cut into slabs at every vertex and crossing. No edges cross within a slab, so covered length is linear
    in x there and the middle times the width is exact. Holes, concave rings and overlapping hazards need no care.
    """
    own = edges(parcel)
    if not len(own):
        return 0.0, 0.0
    lo, hi = own[:, [0, 2]].min(), own[:, [0, 2]].max()
    low, high = (-np.inf, np.inf) if box is None else (box[1], box[3])
    if box is not None:
        lo, hi = max(lo, box[0]), min(hi, box[2])
    if lo >= hi:
        return 0.0, 0.0
    bottom, top = max(low, own[:, [1, 3]].min()), min(high, own[:, [1, 3]].max())
    if whole := next((h for h in hazards if _covers(edges(h), lo, bottom, hi, top)), None):
        hazards = [whole]
    spans = lambda e: e[(np.maximum(e[:, 0], e[:, 2]) > lo) & (np.minimum(e[:, 0], e[:, 2]) < hi)]
    own, near = spans(own), [spans(e) for e in map(edges, hazards)]
    every = np.concatenate([own, *near])
    every = every[(np.maximum(every[:, 1], every[:, 3]) >= low) & (np.minimum(every[:, 1], every[:, 3]) <= high)]  # what crosses elsewhere doesn't count
    borders = [_at_height(every, y) for y in (low, high) if np.isfinite(y)]
    cuts = np.unique(np.clip(np.concatenate([[lo, hi], every[:, 0], every[:, 2], _crossings(every), *borders]), lo, hi))
    area = covered = 0.0
    for a, b in zip(cuts, cuts[1:], strict=False):
        x = (a + b) / 2
        inside = [(max(c, low), min(d, high)) for c, d in _intervals(own, x) if c < high and d > low]
        if not inside:
            continue
        union = _merged([i for e in near for i in _intervals(e, x)])
        area += sum(d - c for c, d in inside) * (b - a)
        covered += sum(max(0.0, min(d, f) - max(c, e)) for c, d in inside for e, f in union) * (b - a)
    return area, covered


def _covers(e: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> bool:
    """Whether the shape holds the whole box: no edge's bounds touch it, and its middle is inside. An edge that runs past a corner may hide that."""
    x, y = (e[:, 0], e[:, 2]), (e[:, 1], e[:, 3])
    if ((np.minimum(*x) <= x1) & (np.maximum(*x) >= x0) & (np.minimum(*y) <= y1) & (np.maximum(*y) >= y0)).any():
        return False
    return _odd(e, (x0 + x1) / 2, (y0 + y1) / 2)


def _at_height(e: np.ndarray, y: float) -> np.ndarray:
    """x where edges cross a height."""
    cross = (np.minimum(e[:, 1], e[:, 3]) < y) & (np.maximum(e[:, 1], e[:, 3]) > y)
    e = e[cross]
    return e[:, 0] + (y - e[:, 1]) / (e[:, 3] - e[:, 1]) * (e[:, 2] - e[:, 0])


def contains(rings: list[Ring], x: float, y: float) -> bool:
    """Even-odd test of a point."""
    return _odd(edges(rings), x, y)


def _odd(e: np.ndarray, x: float, y: float) -> bool:
    up = (e[:, 1] > y) != (e[:, 3] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = e[:, 0] + (y - e[:, 1]) / (e[:, 3] - e[:, 1]) * (e[:, 2] - e[:, 0])
    return bool((up & (at > x)).sum() % 2)


#: Numbers that one step over stacked rows holds at most, but for one row alone.
STACK = 1_000_000


def _stacked(rows: list[tuple[np.ndarray, ...]]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """(places, arrays [n, ...]) of rows of two or more arrays, those whose arrays have equal shapes side by side."""
    alike: dict[tuple, list[int]] = {}
    for i, row in enumerate(rows):
        alike.setdefault(tuple(a.shape for a in row), []).append(i)
    for (own, lines, *_), places in alike.items():
        step = max(1, STACK // max(1, own[0] * lines[0]))
        for k in range(0, len(places) if own[0] and lines[0] else 0, step):
            at = places[k : k + step]
            yield at, [np.stack(c) for c in zip(*(rows[i] for i in at), strict=True)]


def _point_segment(p: np.ndarray, s: np.ndarray) -> np.ndarray:
    """[n, a, b] distances of points [n, a, 2] from segments [n, b, 4]."""
    a, d = s[:, None, :, :2], (s[..., 2:] - s[..., :2])[:, None]
    t = np.clip(((p[:, :, None] - a) * d).sum(axis=3) / np.maximum((d * d).sum(axis=3), 1e-300), 0, 1)
    return np.sqrt((((a + t[..., None] * d) - p[:, :, None]) ** 2).sum(axis=3))


def distance(parcel: list[Ring], lines: np.ndarray) -> float:
    """Least distance of line segments from the parcel; 0 where they meet or a line lies inside."""
    return float(distances([(edges(parcel), lines)])[0])


def distances(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The same for each row of a parcel's edges and line segments."""
    out = np.full(len(rows), np.inf)
    for at, (own, lines) in _stacked(rows):
        x, y, e = lines[:, :, None, 0], lines[:, :, None, 1], own[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            cut = e[..., 0] + (y - e[..., 1]) / (e[..., 3] - e[..., 1]) * (e[..., 2] - e[..., 0])
        inside = ((((e[..., 1] > y) != (e[..., 3] > y)) & (cut > x)).sum(axis=2) % 2 == 1).any(axis=1)
        ends = lambda s: np.concatenate([s[..., :2], s[..., 2:]], axis=1)
        apart = np.minimum(_point_segment(ends(lines), own).min(axis=(1, 2)), _point_segment(ends(own), lines).min(axis=(1, 2)))
        out[at] = np.where(inside | _meet(own, lines), 0.0, apart)
    return out


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """[n]: whether any of the segments [n, a, 4] meets any of [n, b, 4]."""
    cross = lambda o, d, p: d[..., 0] * (p[..., 1] - o[..., 1]) - d[..., 1] * (p[..., 0] - o[..., 0])
    pa, da, pb, db = a[:, :, None, :2], (a[..., 2:] - a[..., :2])[:, :, None], b[:, None, :, :2], (b[..., 2:] - b[..., :2])[:, None]
    bounds = (np.maximum(np.minimum(pa, pa + da), np.minimum(pb, pb + db)) <= np.minimum(np.maximum(pa, pa + da), np.maximum(pb, pb + db))).all(axis=3)  # segments of one line may lie apart
    return (bounds & (cross(pa, da, pb) * cross(pa, da, pb + db) <= 0) & (cross(pb, db, pa) * cross(pb, db, pa + da) <= 0)).any(axis=(1, 2))


def _clip(s: np.ndarray, box: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The part of each segment [n, m, 4], from 0 to 1, in its box [n, 4], 0 to 0 if none; a box's right and upper sides belong to the next one."""
    lo, hi = np.zeros(s.shape[:2]), np.ones(s.shape[:2])
    for k in (0, 1):
        at, step, least, most = s[..., k], s[..., k + 2] - s[..., k], box[:, k, None], box[:, k + 2, None]
        lo, hi = _between(lo, hi, at, step, least, most, step == 0, (least <= at) & (at < most))
    return np.where(lo < hi, lo, 0.0), np.where(lo < hi, hi, 0.0)


def _between(lo, hi, start, slope, least, most, flat, held) -> tuple[np.ndarray, np.ndarray]:
    """lo to hi without where start + t * slope isn't between least and most; where it is flat, all or nothing."""
    with np.errstate(divide="ignore", invalid="ignore"):
        a, b = (least - start) / slope, (most - start) / slope
    lo = np.where(flat, lo, np.maximum(lo, np.minimum(a, b)))
    return lo, np.where(flat, np.where(held, hi, -np.inf), np.minimum(hi, np.maximum(a, b)))


def length_near(boundary: np.ndarray, lines: np.ndarray, reach: float, box: Box | None = None) -> float:
    """Length of the boundary's segments within reach of any line segment: intervals of each are merged, so none counts twice. With a box, of what lies in it: lengths of boxes side by side add up."""
    return float(lengths_near([(boundary, lines, np.array(box or (-np.inf, -np.inf, np.inf, np.inf)))], reach)[0])


def lengths_near(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], reach: float) -> np.ndarray:
    """The same for each row of boundary segments, line segments and a box.

    A segment is within reach of another along the interval where it lies in a stadium: a strip and two end circles.
    """
    out = np.zeros(len(rows))
    for at, (own, lines, box) in _stacked(rows):
        first, last = _clip(own, box)
        p, d, a, e = own[:, :, None, :2], (own[..., 2:] - own[..., :2])[:, :, None], lines[:, None, :, :2], (lines[..., 2:] - lines[..., :2])[:, None]
        spans = [_circle(p, d, a, reach), _circle(p, d, lines[:, None, :, 2:], reach), _strip(p, d, a, e, reach)]
        lo = np.minimum.reduce([np.where(x < y, x, np.inf) for x, y in spans])  # the stadium is convex
        hi = np.maximum.reduce([np.where(x < y, y, -np.inf) for x, y in spans])
        lo, hi = np.maximum(lo, first[..., None]), np.minimum(hi, last[..., None])
        lo, hi = np.where(lo < hi, lo, 0.0), np.where(lo < hi, hi, 0.0)
        turn = np.argsort(lo, axis=2)
        lo, hi = np.take_along_axis(lo, turn, 2), np.take_along_axis(hi, turn, 2)
        before = np.concatenate([np.zeros_like(hi[..., :1]), np.maximum.accumulate(hi, axis=2)[..., :-1]], axis=2)
        part = np.maximum(0.0, hi - np.maximum(lo, before)).sum(axis=2)
        out[at] = (np.hypot(d[:, :, 0, 0], d[:, :, 0, 1]) * part).sum(axis=1)
    return out


def _circle(p: np.ndarray, d: np.ndarray, c: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    f = p - c
    a, b, k = (d * d).sum(axis=3), 2 * (f * d).sum(axis=3), (f * f).sum(axis=3) - r * r
    with np.errstate(divide="ignore", invalid="ignore"):
        root = np.sqrt(b * b - 4 * a * k)  # none: no number, which is never less than another
        return np.maximum(0.0, (-b - root) / (2 * a)), np.minimum(1.0, (-b + root) / (2 * a))


def _strip(p: np.ndarray, d: np.ndarray, a: np.ndarray, e: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    long = np.hypot(e[..., 0], e[..., 1])
    u = e / np.where(long > 0, long, 1.0)[..., None]
    v = np.stack([-u[..., 1], u[..., 0]], axis=-1)
    lo, hi = np.zeros(np.broadcast_shapes(p.shape, a.shape)[:3]), np.where(long > 0, 1.0, -np.inf)
    for w, least, most in ((u, 0.0, long), (v, -r, r)):
        start, slope = ((p - a) * w).sum(axis=3), (d * w).sum(axis=3)
        lo, hi = _between(lo, hi, start, slope, least, most, np.abs(slope) < 1e-15, (least <= start) & (start <= most))
    return lo, hi
