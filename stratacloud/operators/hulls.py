"""Convex hulls, Delaunay triangles, alpha shapes and meshes of clusters: numpy kernels over one bounded group each."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Points of a group that a kernel takes: more raise, they are to be thinned (voxel_downsample) first.
MOST_POINTS = 100_000


def _normals(p: np.ndarray, faces: np.ndarray) -> np.ndarray:
    a, b, c = (p[faces[:, k]] for k in range(3))
    return np.cross(b - a, c - a)


def hull_faces(points: np.ndarray) -> np.ndarray:
    """Triangles (outward) of the convex hull of (n, 3) points, which is grown by the farthest point above a face at a time; none if
    all points lie in a plane."""
    p = np.asarray(points, float)
    if len(p) < 4:
        return np.zeros((0, 3), int)
    scale = np.ptp(p, axis=0).max() or 1.0
    eps = 1e-10 * scale
    a = int(np.lexsort(p.T[::-1])[0])
    b = int(np.linalg.norm(p - p[a], axis=1).argmax())
    c = int(np.linalg.norm(np.cross(p - p[a], p[b] - p[a]), axis=1).argmax())
    normal = np.cross(p[b] - p[a], p[c] - p[a])
    height = (p - p[a]) @ normal
    d = int(np.abs(height).argmax())
    if np.abs(height[d]) <= eps * (np.linalg.norm(normal) or 1.0) or not np.linalg.norm(normal) > eps * scale:
        return np.zeros((0, 3), int)
    if height[d] > 0:
        b, c = c, b
    faces, alive = np.zeros((8 * len(p), 3), int), np.zeros(8 * len(p), bool)
    normals, offsets = np.zeros((8 * len(p), 3)), np.zeros(8 * len(p))
    owner = np.full(len(p), -1)  # a face that the point lies above
    n = 0

    def add(new: np.ndarray, candidates: np.ndarray) -> None:
        nonlocal n, faces, alive, normals, offsets
        if n + len(new) > len(faces):
            faces, alive, normals, offsets = (np.concatenate([x, np.zeros_like(x)]) for x in (faces, alive, normals, offsets))
        at = slice(n, n + len(new))
        v = _normals(p, new)
        length = np.linalg.norm(v, axis=1, keepdims=True)
        faces[at], alive[at], normals[at] = new, True, v / np.where(length > 0, length, 1)
        offsets[at] = (normals[at] * p[new[:, 0]]).sum(axis=1)
        if len(candidates):
            above = p[candidates] @ normals[at].T - offsets[at]
            best = above.argmax(axis=1)
            owner[candidates] = np.where(above[np.arange(len(candidates)), best] > eps, n + best, -1)
        n += len(new)

    add(np.array([(a, b, c), (a, d, b), (b, d, c), (c, d, a)]), np.setdiff1d(np.arange(len(p)), [a, b, c, d]))
    todo = np.flatnonzero(owner >= 0)
    while len(todo):
        face = owner[todo[0]]
        own = np.flatnonzero(owner == face)
        k = int(own[(p[own] @ normals[face]).argmax()])
        seen = np.flatnonzero(alive[:n] & (normals[:n] @ p[k] - offsets[:n] > eps))
        edges = Counter((f[i], f[(i + 1) % 3]) for f in faces[seen].tolist() for i in range(3))
        alive[seen] = False
        owner[k] = -1
        lost = np.flatnonzero(np.isin(owner, seen))
        add(np.array([(i, j, k) for i, j in edges if (j, i) not in edges]), lost)
        todo = np.flatnonzero(owner >= 0)
    return faces[:n][alive[:n]]


def delaunay(flat: np.ndarray) -> np.ndarray:
    """Triangles of (n, 2) points: the lower faces of the hull of the points lifted onto a paraboloid."""
    q = np.asarray(flat, float)
    if len(q) == 3:
        (ax, ay), (bx, by) = q[1] - q[0], q[2] - q[0]
        turn = ax * by - ay * bx
        return np.array([(0, 1, 2) if turn > 0 else (0, 2, 1)]) if abs(turn) > 0 else np.zeros((0, 3), int)
    if len(q) < 4:
        return np.zeros((0, 3), int)
    if np.linalg.matrix_rank(q - q[0]) < 2:
        return np.zeros((0, 3), int)
    q = (q - q.mean(axis=0)) / (np.ptp(q, axis=0).max() or 1.0)
    lifted = np.column_stack([q, (q * q).sum(axis=1)])
    faces = hull_faces(lifted)
    if not len(faces):  # four points or more on one circle
        around = np.argsort(np.arctan2(q[:, 1], q[:, 0]))
        return np.array([(around[0], i, j) for i, j in zip(around[1:], around[2:])])
    lower = _normals(lifted, faces)[:, 2] < 0
    t = faces[lower]
    u, v = q[t[:, 1]] - q[t[:, 0]], q[t[:, 2]] - q[t[:, 0]]
    area = u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]
    t = t[np.abs(area) > 1e-14]
    return np.where((area[np.abs(area) > 1e-14] < 0)[:, None], t[:, ::-1], t)


def alpha_triangles(flat: np.ndarray, alpha: float) -> np.ndarray:
    """Delaunay triangles whose circumradius is less than 1 / alpha."""
    t = delaunay(flat)
    a, b, c = (flat[t[:, k]] for k in range(3))
    x, y, z = (np.linalg.norm(u - v, axis=1) for u, v in ((a, b), (b, c), (c, a)))
    s = (x + y + z) / 2
    area = np.sqrt(np.maximum(s * (s - x) * (s - y) * (s - z), 0))
    return t[x * y * z < 4 * area / alpha]


def boundary(triangles: np.ndarray) -> list[tuple[int, int]]:
    """Directed edges that one triangle has."""
    edges = Counter((t[i], t[(i + 1) % 3]) for t in triangles.tolist() for i in range(3))
    return sorted(e for e in edges if e[::-1] not in edges)


def _grouped(points: DataFrame, key: str, kernel, columns: str, most: int = MOST_POINTS) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) > most:
            raise ValueError(f"{key} {pdf[key].iloc[0]} has {len(pdf)} points; thin them to {most}")
        pdf = pdf.sort_values(["x", "y", "z"]).drop_duplicates(["x", "y", "z"])
        rows = kernel(pdf[["x", "y", "z"]].to_numpy())
        return pd.DataFrame([(pdf[key].iloc[0], *r) for r in rows], columns=[key, *(c.split()[0] for c in columns.split(", "))])

    kind = points.schema[key].dataType.simpleString()
    return points.select(key, "x", "y", "z").groupBy(key).applyInPandas(run, f"{key} {kind}, {columns}")


_CORNERS = ", ".join(f"{p}{c} double" for p in "abc" for c in "xyz")


def cluster_hulls(points: DataFrame, key: str, least: int = 4, most: int = MOST_POINTS) -> DataFrame:
    """Per key the triangles (outward) of its convex hull: key, fid, ax .. cz; none below `least` points or in a plane."""

    def kernel(p: np.ndarray):
        return [(k, *p[f].ravel().tolist()) for k, f in enumerate(hull_faces(p))] if len(p) >= least else []

    return _grouped(points, key, kernel, f"fid int, {_CORNERS}", most)


def exterior_hulls(points: DataFrame, key: str, nx: float, ny: float, back: float = -0.1) -> DataFrame:
    """As cluster_hulls, without the faces that look back into the wall (unit normal against (nx, ny) below `back`)."""
    h = cluster_hulls(points, key)
    u, v = ({c: F.col(f"{p}{c}") - F.col(f"a{c}") for c in "xyz"} for p in "bc")
    n = {"x": u["y"] * v["z"] - u["z"] * v["y"], "y": u["z"] * v["x"] - u["x"] * v["z"], "z": u["x"] * v["y"] - u["y"] * v["x"]}
    return h.filter((n["x"] * nx + n["y"] * ny) / F.sqrt(sum((c * c for c in n.values()), F.lit(0.0))) >= back)


def alpha_outlines(points: DataFrame, key: str, alpha: float = 0.5) -> DataFrame:
    """Per key the boundary edges, in XY, of its alpha shape, and the shape's area: key, x0, y0, x1, y1, area."""

    def kernel(p: np.ndarray):
        t = alpha_triangles(p[:, :2], alpha)
        u, v = p[t[:, 1], :2] - p[t[:, 0], :2], p[t[:, 2], :2] - p[t[:, 0], :2]
        area = float((u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]).sum() / 2)
        return [(*p[a, :2].tolist(), *p[b, :2].tolist(), area) for a, b in boundary(t)]

    return _grouped(points, key, kernel, "x0 double, y0 double, x1 double, y1 double, area double")


def plane_meshes(points: DataFrame, key: str, longest: float = 1.0) -> DataFrame:
    """Per key, whose points lie near a plane, the Delaunay triangles in that plane without edges longer than `longest`."""

    def kernel(p: np.ndarray):
        if len(p) < 3:
            return []
        axes = np.linalg.svd(p - p.mean(axis=0), full_matrices=False)[2][:2]
        t = delaunay(p @ axes.T)
        sides = np.stack([np.linalg.norm(p[t[:, i]] - p[t[:, j]], axis=1) for i, j in ((0, 1), (1, 2), (2, 0))])
        return [(k, *p[f].ravel().tolist()) for k, f in enumerate(t[(sides <= longest).all(axis=0)])]

    return _grouped(points, key, kernel, f"fid int, {_CORNERS}")
