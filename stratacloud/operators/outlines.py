"""Outlines of groups of walls in one plane, as numpy kernels over the walls of one object."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import product
from math import atan2

import numpy as np

#: A vertex lies on an edge if it is as near to it.
ON_EDGE = 1e-3


def points(ring) -> np.ndarray:
    return np.array([(p["x"], p["y"], p["z"]) for p in ring], float).reshape(-1, 3)


class Wall:
    """A wall's rings, exterior first, and its horizontal normal."""

    def __init__(self, idx: int, nx: float, ny: float, rings: list[np.ndarray]):
        self.idx, self.nx, self.ny, self.rings = idx, nx, ny, rings
        self.vertices = np.concatenate(rings)
        self.centre = rings[0].mean(axis=0)

    def flat(self, p: np.ndarray) -> np.ndarray:
        """Coordinates along the wall and up: rings that face as the wall does run counter-clockwise."""
        return np.stack([p[..., 1] * self.nx - p[..., 0] * self.ny, p[..., 2]], axis=-1)

    def depth(self, p: np.ndarray) -> np.ndarray:
        return p[..., 0] * self.nx + p[..., 1] * self.ny


def signed_area(flat: np.ndarray) -> float:
    after = np.roll(flat, -1, axis=0)
    return float((flat[:, 0] * after[:, 1] - after[:, 0] * flat[:, 1]).sum() / 2)


def area(ring: np.ndarray, wall: Wall) -> float:
    return signed_area(wall.flat(ring))


class Places:
    """Points numbered so that those nearer than a distance to an earlier one have its number."""

    def __init__(self, near: float):
        self.near, self.cells, self.found = near, defaultdict(list), []

    def number(self, p: np.ndarray) -> int:
        cell = tuple(np.floor(p / self.near).astype(int))
        for step in product((-1, 0, 1), repeat=3):
            for k in self.cells.get((cell[0] + step[0], cell[1] + step[1], cell[2] + step[2]), ()):
                if np.linalg.norm(self.found[k] - p) < self.near:
                    return k
        self.cells[cell].append(len(self.found))
        self.found.append(p)
        return len(self.found) - 1


def _touch(a: Wall, b: Wall, near: float, far: float) -> bool:
    return np.linalg.norm(a.centre - b.centre) <= far and bool((np.linalg.norm(a.vertices[:, None] - b.vertices[None], axis=2) < near).any())


def groups(walls: list[Wall], cosine: float, reach: float, near: float, far: float) -> Iterator[list[Wall]]:
    """Seeds in order, each with the walls that lie in its plane and are joined to it by shared vertices."""
    free = list(walls)
    while free:
        seed = free.pop(0)
        depth = seed.depth(seed.rings[0][0])
        able = [w for w in free if w.nx * seed.nx + w.ny * seed.ny >= cosine and (np.abs(seed.depth(w.rings[0]) - depth) < reach).all()]
        group, fresh = [seed], [seed]
        while fresh:
            joined = [w for w in able if any(_touch(w, m, near, far) for m in fresh)]
            able = [w for w in able if w not in joined]
            group, fresh = group + joined, joined
        members = set(map(id, group))
        free = [w for w in free if id(w) not in members]
        yield group


def _loops(edges: list[tuple[int, int]], flat: np.ndarray) -> list[list[int]] | None:
    """Closed walks over all edges; where several leave a vertex, the sharpest turn to the right is taken."""
    leaving = defaultdict(list)
    for a, b in edges:
        leaving[a].append(b)
    out = []
    while any(leaving.values()):
        start = min(k for k, v in leaving.items() if v)
        walk, here = [start], leaving[start].pop()
        while here != start:
            if not leaving[here]:
                return None
            back = flat[walk[-1]] - flat[here]
            turn = lambda b, here=here, back=back: (atan2(*(flat[b] - flat[here])[::-1]) - atan2(back[1], back[0])) % (2 * np.pi) or 2 * np.pi
            after = max(leaving[here], key=turn) if len(leaving[here]) > 1 else leaving[here][0]
            leaving[here].remove(after)
            walk.append(here)
            here = after
        out.append(walk)
    return out


def _crosses(starts: np.ndarray, ends: np.ndarray) -> bool:
    """Whether two of the edges properly cross."""
    side = lambda a, b, c: (b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0])
    for k in range(len(starts) - 1):
        a, b, c, d = starts[k], ends[k], starts[k + 1 :], ends[k + 1 :]
        if ((side(a, b, c) * side(a, b, d) < -1e-12) & (side(c, d, a) * side(c, d, b) < -1e-12)).any():
            return True
    return False


def inside(p: np.ndarray, ring: np.ndarray) -> bool:
    after = np.roll(ring, -1, axis=0)
    over = (ring[:, 1] > p[1]) != (after[:, 1] > p[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        x = ring[:, 0] + (p[1] - ring[:, 1]) / (after[:, 1] - ring[:, 1]) * (after[:, 0] - ring[:, 0])
    return bool(np.count_nonzero(over & (p[0] < x)) % 2)


def hull(flat: np.ndarray) -> list[int]:
    """Numbers of the points of the convex hull, counter-clockwise."""
    order = sorted(range(len(flat)), key=lambda k: tuple(flat[k]))

    def half(items):
        out = []
        for k in items:
            while len(out) > 1 and np.linalg.det(np.stack([flat[out[-1]] - flat[out[-2]], flat[k] - flat[out[-2]]])) <= 1e-12:
                out.pop()
            out.append(k)
        return out[:-1]

    return [*half(order), *half(order[::-1])]


def pieces(group: list[Wall], near: float, least_hole: float) -> list[tuple[list[np.ndarray], str]]:
    """The rings of each piece of the group's outline, exterior first, and how it was made."""
    seed = group[0]
    if len(group) == 1:
        return [(seed.rings, "alone")]
    places, rings = Places(near), []
    for w in group:
        for r in w.rings:
            ring = [places.number(p) for p in r]
            rings.append([k for k, before in zip(ring, [ring[-1], *ring[:-1]], strict=True) if k != before])
    at = np.array(places.found)
    flat = seed.flat(at)
    edges: Counter = Counter()
    for ring in rings:
        for a, b in zip(ring, [*ring[1:], *ring[:1]], strict=True):
            along = flat[b] - flat[a]
            length = float(np.linalg.norm(along))
            if not length:
                continue
            rel = flat - flat[a]
            t = rel @ along / length
            on = np.flatnonzero((np.abs(rel[:, 0] * along[1] - rel[:, 1] * along[0]) / length < ON_EDGE) & (t > ON_EDGE) & (t < length - ON_EDGE))
            stops = [a, *on[np.argsort(t[on])].tolist(), b]
            for c, d in zip(stops, stops[1:]):
                if edges[d, c]:
                    edges[d, c] -= 1
                else:
                    edges[c, d] += 1
    left = sorted(e for e, n in edges.items() if n)
    loops = _loops(left, flat)
    # walls that overlap leave edges that cross or occur twice
    if not loops or max(edges.values()) > 1 or _crosses(*(flat[[e[k] for e in left]] for k in (0, 1))):
        return [([at[hull(flat)]], "hull")]
    sized = [(signed_area(flat[k]), k) for k in loops]
    outer = [k for size, k in sized if size > 1e-9]
    if not outer:
        return [([at[hull(flat)]], "hull")]
    outer.sort(key=lambda k: signed_area(flat[k]))
    owned = defaultdict(list)  # a hole is the smallest piece's that holds it
    for hole in (k for size, k in sized if size <= -least_hole):
        owned[next((n for n, ring in enumerate(outer) if inside((flat[hole[0]] + flat[hole[1]]) / 2, flat[ring])), len(outer) - 1)].append(hole)
    out = []
    for n, ring in enumerate(outer):
        holes = owned[n]
        whole = all(inside((flat[h[0]] + flat[h[1]]) / 2, flat[ring]) or set(h) & set(ring) for h in holes)
        out.append(([at[ring], *(at[h] for h in (holes if whole else []))], "outline" if whole else "exterior"))
    return out
