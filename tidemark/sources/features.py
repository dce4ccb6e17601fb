"""A Python data source for feature files: ``(geometry WKB, crs, properties JSON)``.

Files are GeoJSON feature collections (``.geojson``), newline-delimited features (``.geojsonl``), or zip
archives with such members. Newline-delimited files are cut into byte ranges of ``split_bytes``, other files are one
partition each. ``path`` and ``layer_name`` are mandatory: ``path`` is a folder every worker can reach under the same
name, ``layer_name`` is the collection's ``name`` or the file's stem. ``columns`` names the columns that are wanted;
the others are NULL and never built. Filters on ``crs`` are taken over: features of another crs are not encoded, and lines
that name none are not even parsed where 4326 is not asked for.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition

from tidemark.sources.files import open_filesystem

SUFFIXES = (".geojson", ".geojsonl", ".zip")
FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("geometry", T.BinaryType(), True),
        T.StructField("crs", T.IntegerType(), True),
        T.StructField("properties", T.StringType(), True),
    ]
)
DEFAULT_CRS = 4326

SPLIT_BYTES = 64 << 20
FILTER_PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"

# Well-known-binary type codes (fixed values).
WKB_POINT, WKB_LINESTRING, WKB_POLYGON = 1, 2, 3
WKB_PARTS = {"MultiPoint": (4, "Point"), "MultiLineString": (5, "LineString"), "MultiPolygon": (6, "Polygon")}
WKB_MULTIPOLYGON, WKB_COLLECTION = 6, 7
POINT_BYTES = 21


def to_wkb(geometry: dict | None) -> bytes | None:
    """Little-endian well-known binary of a geometry of any kind; NULL for a missing, empty or unknown one."""
    if geometry is None:
        return None
    kind, coordinates = geometry.get("type"), geometry.get("coordinates")
    if kind == "GeometryCollection":
        parts = [to_wkb(part) for part in geometry.get("geometries") or ()]
        parts = [part for part in parts if part]
        return struct.pack("<BII", 1, WKB_COLLECTION, len(parts)) + b"".join(parts)
    if not coordinates:
        return None

    def positions(points: list) -> bytes:
        return struct.pack("<I", len(points)) + b"".join(struct.pack("<dd", p[0], p[1]) for p in points)

    if kind == "Point":
        return struct.pack("<BIdd", 1, WKB_POINT, coordinates[0], coordinates[1])
    if kind == "LineString":
        return struct.pack("<BI", 1, WKB_LINESTRING) + positions(coordinates)
    if kind == "Polygon":
        head = struct.pack("<BII", 1, WKB_POLYGON, len(coordinates))
        return head + b"".join(positions(ring) for ring in coordinates)
    if kind in WKB_PARTS:
        code, part = WKB_PARTS[kind]
        parts = [to_wkb({"type": part, "coordinates": c}) for c in coordinates]
        return struct.pack("<BII", 1, code, len(coordinates)) + b"".join(p for p in parts if p)
    return None


def epsg_of(document: dict) -> int:
    """EPSG code of the ``crs`` member, or 4326 when there is none."""
    name = ((document.get("crs") or {}).get("properties") or {}).get("name")
    if name is None or name.endswith("CRS84"):
        return DEFAULT_CRS
    code = re.search(r"EPSG:+(?:[\d.]*:)?(\d+)$", name)
    if code is None:
        raise ValueError(f"unknown crs {name}")
    return int(code.group(1))


class FeatureFile(InputPartition):
    """A file, or the lines of it that begin in a range of bytes."""

    def __init__(self, path: str, start: int = 0, end: int | None = None):
        self.path, self.start, self.end = path, start, end


class FeatureReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options.get("path")
        self.layer = options.get("layer_name")
        for name, value in (("path", self.folder), ("layer_name", self.layer)):
            if not value:
                raise ValueError(f"option '{name}' is required")
        self.split_bytes = int(options.get("split_bytes") or SPLIT_BYTES)
        self.columns = frozenset(c.strip() for c in (options.get("columns") or ",".join(FEATURE_SCHEMA.names)).split(","))
        if not self.columns <= set(FEATURE_SCHEMA.names):
            raise ValueError(f"option 'columns' takes {', '.join(FEATURE_SCHEMA.names)}")
        self.wanted_crs: frozenset[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes over what asks for values of ``crs`` and leaves the rest to Spark."""
        for condition in filters:
            values = None
            if isinstance(condition, (EqualTo, EqualNullSafe)) and condition.attribute == ("crs",):
                values = frozenset([condition.value])
            elif isinstance(condition, In) and condition.attribute == ("crs",):
                values = frozenset(condition.value)
            if values is None or None in values:
                yield condition
            else:
                self.wanted_crs = values if self.wanted_crs is None else self.wanted_crs & values

    def partitions(self) -> list[FeatureFile]:
        filesystem, root = open_filesystem(self.folder)
        if filesystem.get_file_info(root).type == pafs.FileType.NotFound:
            raise FileNotFoundError(f"no feature files at {self.folder}")
        listed = filesystem.get_file_info(pafs.FileSelector(root, recursive=True))
        scheme = self.folder.partition("://")[0] + "://" if "://" in self.folder else ""
        found = []
        for info in sorted(listed, key=lambda info: info.path):
            path = info.path if info.path.startswith("/") and not scheme else scheme + info.path
            if info.path.endswith(".geojsonl"):
                found += [FeatureFile(path, a, a + self.split_bytes) for a in range(0, info.size, self.split_bytes)]
            elif info.path.endswith(SUFFIXES):
                found.append(FeatureFile(path))
        return found or [FeatureFile("")]

    def read(self, partition: FeatureFile) -> Iterator[tuple[bytes | None, int | None, str | None]]:
        if not partition.path:  # an empty folder
            return
        filesystem, path = open_filesystem(partition.path)
        with filesystem.open_input_file(path) as handle:
            if partition.end is not None:
                yield from self._features(path, _lines_from(handle, partition.start, partition.end))
            elif not path.endswith(".zip"):
                yield from self._features(path, handle)
            else:
                with zipfile.ZipFile(handle) as archive:
                    for member in archive.namelist():
                        if member.endswith(SUFFIXES[:2]):
                            with archive.open(member) as stream:
                                yield from self._features(member, stream)

    def _parsed(self, lines: Iterable[bytes]) -> Iterator[dict]:
        default = self.wanted_crs is None or DEFAULT_CRS in self.wanted_crs
        for line in lines:
            if line.strip() and (default or b'"crs"' in line):
                yield json.loads(line)

    def _features(self, name: str, stream) -> Iterator[tuple[bytes | None, int | None, str | None]]:
        stem = os.path.basename(name).rsplit(".", 1)[0]
        if name.endswith(".geojsonl"):
            header, features = {"name": stem}, self._parsed(stream)
        else:
            header = json.load(stream)
            features = header["features"]
        if self.layer not in (header.get("name"), stem):
            raise ValueError(f"{name} has no layer {self.layer}")
        crs = epsg_of(header)
        geometry, number, properties = (c in self.columns for c in FEATURE_SCHEMA.names)
        for feature in features:
            own = epsg_of(feature) if "crs" in feature else crs
            if self.wanted_crs is None or own in self.wanted_crs:
                yield (
                    to_wkb(feature["geometry"]) if geometry else None,
                    own if number else None,
                    json.dumps(feature["properties"]) if properties else None,
                )


def _lines_from(handle, start: int, end: int) -> Iterator[bytes]:
    """The lines that begin at ``start`` or later and before ``end``."""
    handle, at = io.BufferedReader(handle, 1 << 20), start
    if start:  # the line that is under way belongs to the range before, unless one ends just here
        handle.seek(start - 1)
        at += len(handle.readline()) - 1
    else:
        handle.seek(0)
    while at < end and (line := handle.readline()):
        at += len(line)
        yield line


class FeatureSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "features"

    def schema(self) -> T.StructType:
        return FEATURE_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return FeatureReader(self.options)


def read_features(
    spark: SparkSession, path: str, layer_name: str, columns: tuple[str, ...] | None = None, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """The layer's features; with ``columns``, only those are built and returned."""
    spark.dataSource.register(FeatureSource)
    spark.conf.set(FILTER_PUSHDOWN_CONF, "true")
    reader = spark.read.format("features").option("layer_name", layer_name).option("split_bytes", str(split_bytes))
    if columns is None:
        return reader.load(path)
    return reader.option("columns", ",".join(columns)).load(path).select(*columns)


@F.pandas_udf(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
def wkb_point_xy(geometry: pd.Series) -> pd.DataFrame:
    """Coordinates of point geometries; NULL for NULL, an error for any other type."""

    out = np.full((len(geometry), 2), np.nan)
    known = np.flatnonzero(geometry.notna().to_numpy())
    raw = [bytes(g) for g in geometry.iloc[known]]
    wrong = [g for g in raw if len(g) != POINT_BYTES]
    if wrong:
        raise ValueError(f"expected a point, got geometry type {struct.unpack('<I' if wrong[0][0] == 1 else '>I', wrong[0][1:5])[0]}")
    for flag, order in ((1, "<"), (0, ">")):
        layout = np.dtype([("order", "u1"), ("code", f"{order}u4"), ("x", f"{order}f8"), ("y", f"{order}f8")])
        points = np.frombuffer(b"".join(raw), dtype=layout)
        own = points["order"] == flag
        if (points["code"][own] != WKB_POINT).any():
            raise ValueError(f"expected a point, got geometry type {points['code'][own].max()}")
        out[known[own], 0], out[known[own], 1] = points["x"][own], points["y"][own]
    return pd.DataFrame(out, columns=["x", "y"])


def with_point_xy(features: DataFrame, x: str = "easting", y: str = "northing") -> DataFrame:
    """Decode the point geometry into two double columns."""
    decoded = features.withColumn("_xy", wkb_point_xy("geometry"))
    return decoded.withColumns({x: F.col("_xy.x"), y: F.col("_xy.y")}).drop("_xy")


RINGS = T.ArrayType(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))
_VERTEX = pa.struct([pa.field("x", pa.float64()), pa.field("y", pa.float64())])


def polygon_rings(wkb: bytes) -> list[np.ndarray] | None:
    """The rings of a polygon or of all parts of a multi-polygon, each as rows of x and y; None for anything else."""
    at = 0

    def head() -> tuple[str, int, int]:
        nonlocal at
        order = "<" if wkb[at] == 1 else ">"
        kind, many = struct.unpack_from(f"{order}II", wkb, at + 1)
        at += 9
        return order, kind, many

    def polygon(order: str, many: int) -> list[np.ndarray]:
        nonlocal at
        rings = []
        for _ in range(many):
            (points,) = struct.unpack_from(f"{order}I", wkb, at)
            rings.append(np.frombuffer(wkb, dtype=f"{order}f8", count=2 * points, offset=at + 4).reshape(-1, 2))
            at += 4 + 16 * points
        return rings

    try:
        order, kind, many = head()
        if kind == WKB_POLYGON:
            return polygon(order, many)
        if kind != WKB_MULTIPOLYGON:
            return None
        rings = []
        for _ in range(many):
            order, kind, inner = head()
            if kind != WKB_POLYGON:
                return None
            rings += polygon(order, inner)
        return rings
    except (struct.error, ValueError, IndexError):  # it ends too early
        return None


@F.arrow_udf(RINGS)
def wkb_rings(geometry: pa.Array) -> pa.Array:
    """All rings, holes included, of polygons and multi-polygons; NULL for other geometries and for unreadable ones."""
    found = [polygon_rings(g) if g is not None else None for g in geometry.to_pylist()]
    rings = [ring for several in found if several for ring in several]
    points = np.vstack([np.zeros((0, 2)), *rings]).astype(np.float64)
    vertices = pa.StructArray.from_arrays([pa.array(c) for c in points.T.copy()], fields=list(_VERTEX))
    inner = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rings)]).astype(np.int32)), vertices)
    outer = np.cumsum([0, *(len(several or ()) for several in found)]).astype(np.int32)
    missing = pa.array([several is None for several in found], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(outer), inner, mask=missing)
