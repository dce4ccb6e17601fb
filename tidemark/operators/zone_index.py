"""Crossing-parity index of polygons: which squares a zone covers, and the few edges that matter inside each.

A zone is all its rings at once (outer rings and holes alike) under the even-odd rule. It is laid on a grid of about as
many squares as it has vertices. Each square that an edge passes holds those edges and whether its lower left corner is
inside; squares wholly inside hold no edges, squares wholly outside do not exist. A point is inside if its square's corner
is, turned once for every edge that the way from the corner - up, then to the right - crosses.

Both sides of a crossing are told by the sign of one product of coordinates, computed the same way here and in the join,
so a point of the way that lies within rounding of an edge is on the same side for both legs. A point on an edge is to its
right, and a point as high as a vertex above it, as in the plain even-odd test.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_DEG = 1.0 / 128
#: Squares along either side of a zone's grid at most.
MOST_SQUARES = 1024
#: Part of a square's side by which edges are filed too generously, against rounding.
MARGIN = 1e-9

EDGES = T.ArrayType(
    T.StructType([T.StructField(c, T.DoubleType()) for c in ("ax", "ay", "bx", "by")]), containsNull=False
)
_EDGE = pa.struct([pa.field(c, pa.float64()) for c in ("ax", "ay", "bx", "by")])


def ring_edges(rings: list[list[dict | None] | None] | None) -> np.ndarray:
    """``ax, ay, bx, by`` of the edges of closed or open rings. Rings with a missing coordinate have none."""
    edges = [np.zeros((0, 4))]
    for ring in rings or ():
        points = [(p["x"], p["y"]) if p else (None, None) for p in ring or ()]
        at = np.array(points, dtype=np.float64).reshape(-1, 2)
        if len(at) and np.isfinite(at).all():
            both = np.hstack([at, np.roll(at, -1, axis=0)])
            edges.append(both[(both[:, :2] != both[:, 2:]).any(axis=1)])
    return np.vstack(edges)


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges ``first .. last``: the number of the range and each of its values."""
    many = np.maximum(last - first + 1, 0)
    owner = np.repeat(np.arange(len(first)), many)
    return owner, np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + first[owner]


def _is_left(edges: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether points lie to the left of edges that pass their latitude; a point on an edge does not."""
    ax, ay, bx, by = edges.T
    side = (y - ay) * (bx - ax) - (x - ax) * (by - ay)
    return np.where(by > ay, side > 0, side < 0)


def squares_of(edges: np.ndarray, base: float = BASE_DEG) -> Iterator[tuple[int, int, int, bool, np.ndarray]]:
    """``level, column, row, corner inside, edges`` of a zone's squares; a square's side is ``base * 2**level``."""
    if not len(edges):
        return
    xs, ys = edges[:, [0, 2]], edges[:, [1, 3]]
    extent = max(xs.max() - xs.min(), ys.max() - ys.min())
    wanted = extent / min(MOST_SQUARES, max(1, int(np.sqrt(len(edges)))))
    level = max(0, int(np.ceil(np.log2(max(wanted, base) / base))))
    side = base * 2.0**level
    margin = side * MARGIN

    def number(value: np.ndarray) -> np.ndarray:
        return np.floor(value / side).astype(np.int64)

    # the squares that each edge passes, row by row
    owner, row = _spread(number(ys.min(axis=1) - margin), number(ys.max(axis=1) + margin))
    ax, ay, bx, by = edges[owner].T
    flat = by == ay
    slope = np.where(flat, 0.0, (bx - ax) / np.where(flat, 1.0, by - ay))
    low = np.clip(row * side - margin, np.minimum(ay, by), np.maximum(ay, by))
    high = np.clip((row + 1) * side + margin, np.minimum(ay, by), np.maximum(ay, by))
    ends = [np.where(flat, ax, ax + (low - ay) * slope), np.where(flat, bx, ax + (high - ay) * slope)]
    left, right = np.minimum(*ends) - margin, np.maximum(*ends) + margin
    again, column = _spread(number(left), number(right))
    owner, row = owner[again], row[again]

    # parity of corners: crossings to the right of each, along the lower side of each row
    c0, r0 = int(number(xs.min() - margin)), int(number(ys.min() - margin))
    columns, rows = int(number(xs.max() + margin)) - c0 + 1, int(number(ys.max() + margin)) - r0 + 1
    edge, line = _spread(number(ys.min(axis=1)), number(ys.max(axis=1)) + 1)
    y = line * side
    passing = (edges[edge, 1] > y) != (edges[edge, 3] > y)
    edge, line, y = edge[passing], line[passing], y[passing]
    ax, ay, bx, by = edges[edge].T
    last = number(ax + (y - ay) * (bx - ax) / (by - ay))
    last += _is_left(edges[edge], (last + 1) * side, y)
    last -= ~_is_left(edges[edge], last * side, y)
    crossings = np.zeros((rows, columns + 1), dtype=np.int64)
    seen = (line - r0 >= 0) & (line - r0 < rows)
    np.add.at(crossings, (line[seen] - r0, np.clip(last[seen] - c0, -1, columns - 1) + 1), 1)
    inside = np.cumsum(crossings[:, ::-1], axis=1)[:, ::-1][:, 1:] % 2 == 1

    square = (row - r0) * columns + column - c0
    order = np.argsort(square, kind="stable")
    held, first = np.unique(square[order], return_index=True)
    for number_, a, b in zip(held.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
        r, c = divmod(number_, columns)
        yield level, c + c0, r + r0, bool(inside[r, c]), edges[owner[order[a:b]]]
    empty = np.zeros((0, 4))
    covered = inside.reshape(-1).copy()
    covered[held] = False
    for number_ in np.flatnonzero(covered).tolist():
        r, c = divmod(number_, columns)
        yield level, c + c0, r + r0, True, empty


def zone_squares(zones: DataFrame, base: float = BASE_DEG) -> DataFrame:
    """``zone_id, _level, _gx, _gy, _corner, _edges`` for ``zone_id, rings`` (arrays of rings of x and y).

    A zone without rings, or whose rings have no usable edge, has no squares.
    """
    kind = zones.schema["zone_id"].dataType
    schema = T.StructType(
        [
            T.StructField("zone_id", kind),
            *(T.StructField(c, T.IntegerType()) for c in ("_level", "_gx", "_gy")),
            T.StructField("_corner", T.BooleanType()),
            T.StructField("_edges", EDGES),
        ]
    )
    types = [pa.int32(), pa.int32(), pa.int32(), pa.bool_()]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                found = list(squares_of(ring_edges(batch.column("rings")[i].as_py()), base))
                for a in range(0, len(found), 4096):
                    part = found[a : a + 4096]
                    edges = np.vstack([f[4] for f in part])
                    offsets = np.concatenate([[0], np.cumsum([len(f[4]) for f in part])]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(c) for c in edges.T.copy()], fields=list(_EDGE)))
                    arrays = [pa.array([f[k] for f in part], t) for k, t in enumerate(types)]
                    zone = batch.column("zone_id").take(pa.array([i] * len(part), pa.int64()))
                    yield pa.RecordBatch.from_arrays([zone, *arrays, lists], names=schema.names)

    return zones.select("zone_id", "rings").mapInArrow(index, schema)


def is_inside(x: Column, y: Column, base: float = BASE_DEG) -> Column:
    """Whether a point is inside the zone, from the columns of its square."""
    side = F.lit(base) * F.pow(F.lit(2.0), F.col("_level").cast("double"))
    corner = F.struct((F.col("_gx") * side).alias("x"), (F.col("_gy") * side).alias("y"))

    def is_left(edge: Column, px: Column, py: Column) -> Column:
        side = (py - edge["ay"]) * (edge["bx"] - edge["ax"]) - (px - edge["ax"]) * (edge["by"] - edge["ay"])
        return ((side > 0) & (edge["by"] > edge["ay"])) | ((side < 0) & (edge["by"] < edge["ay"]))

    def turned(parity: Column, edge: Column) -> Column:
        cx, cy = corner["x"], corner["y"]
        ax, ay, bx, by = (edge[c] for c in ("ax", "ay", "bx", "by"))
        at_bend, level = is_left(edge, cx, y), (ay == by) & ((ay > cy) != (ay > y))
        up = ((ax > cx) != (bx > cx)) & ((is_left(edge, cx, cy) != at_bend) | level)
        up &= ((ay > cy) | (by > cy)) & ~((ay > y) & (by > y))
        across = ((ay > y) != (by > y)) & (is_left(edge, x, y) != at_bend)
        across &= ((ax > cx) | (bx > cx)) & ~((ax > x) & (bx > x))
        return parity != (up != across)

    return F.aggregate(F.col("_edges"), F.col("_corner"), turned)
