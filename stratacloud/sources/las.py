"""LAS point files: header, records, and a data source that reads ranges of records in parallel.

Public layout: the header gives the offset and length of the fixed-size records; x, y, z are int32 * scale + offset.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "cloud_id string, pid bigint, x double, y double, z double, intensity int, classification short, gps_time double, red int, green int, blue int, point_source_id int"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Records of one task.
RANGE = 1_000_000
#: Bytes of a record and where time and colour stand, by point format: fixed values.
FORMATS = {0: (20, None, None), 1: (28, 20, None), 2: (26, None, 20), 3: (34, 20, 28), 6: (30, 22, None), 7: (36, 22, 30)}


def parse_header(head: bytes) -> dict:
    if head[:4] != b"LASF":
        raise ValueError("not a LAS file")
    major, minor = head[24], head[25]
    offset, n_vlr, fmt, length, n = struct.unpack_from("<IIBHI", head, 96)
    if (major, minor) >= (1, 4) and n == 0:
        n = struct.unpack_from("<Q", head, 247)[0]
    scales, offsets = struct.unpack_from("<3d", head, 131), struct.unpack_from("<3d", head, 155)
    b = struct.unpack_from("<6d", head, 179)
    return {"version": f"{major}.{minor}", "point_format": fmt & 0x3F, "record_length": length, "n_points": n, "data_offset": offset, "n_vlr": n_vlr, "scales": list(scales), "offsets": list(offsets), "mins": [b[1], b[3], b[5]], "maxs": [b[0], b[2], b[4]]}


def decode(records: bytes, header: dict, cloud_id: str, first: int) -> pa.RecordBatch:
    """Whole records to rows; absent dimensions are null."""
    fmt, length = header["point_format"], header["record_length"]
    size, time_at, color_at = FORMATS[fmt]
    n = len(records) // length
    raw = np.frombuffer(records, np.uint8, n * length).reshape(n, length)
    field = lambda at, t: raw[:, at : at + np.dtype(t).itemsize].copy().view(t).ravel()
    xyz = [field(4 * k, "<i4") * header["scales"][k] + header["offsets"][k] for k in range(3)]
    cls = field(15, "u1") & 31 if fmt < 6 else field(16, "u1")
    source = field(18 if fmt < 6 else 20, "<u2")
    none = lambda t: pa.nulls(n, t)
    color = [pa.array(field(color_at + 2 * k, "<u2").astype(np.int32)) for k in range(3)] if color_at else [none(pa.int32())] * 3
    columns = [pa.array([cloud_id] * n, pa.string()), pa.array(np.arange(first, first + n)), *(pa.array(c) for c in xyz), pa.array(field(12, "<u2").astype(np.int32)), pa.array(cls.astype(np.int16)), pa.array(field(time_at, "<f8")) if time_at else none(pa.float64()), *color, pa.array(source.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, names=COLUMNS)


def encode(points, scale: float = 0.001) -> bytes:
    """A LAS 1.2 image (format 2 with colour, else 0) of a pandas frame with x, y, z and optional columns; offset is the minimum."""
    n = len(points)
    xyz = points[["x", "y", "z"]].to_numpy(float)
    low, high = (xyz.min(axis=0), xyz.max(axis=0)) if n else (np.zeros(3), np.zeros(3))
    has = "red" in points and points["red"].notna().all()
    fmt = 2 if has else 0
    size = FORMATS[fmt][0]
    out = np.zeros((n, size), np.uint8)
    put = lambda at, v, t: out.__setitem__((slice(None), slice(at, at + np.dtype(t).itemsize)), np.asarray(v).astype(t).view(np.uint8).reshape(n, -1))
    ints = np.round((xyz - low) / scale)
    for k in range(3):
        put(4 * k, np.ascontiguousarray(ints[:, k]), "<i4")
    if "intensity" in points:
        put(12, points["intensity"].fillna(0).to_numpy(), "<u2")
    if "classification" in points:
        put(15, points["classification"].fillna(0).to_numpy(), "u1")
    if has:
        for k, c in enumerate(("red", "green", "blue")):
            put(20 + 2 * k, points[c].to_numpy(), "<u2")
    head = bytearray(227)
    head[:4], head[24], head[25] = b"LASF", 1, 2
    struct.pack_into("<H", head, 94, 227)
    struct.pack_into("<IIBHI", head, 96, 227, 0, fmt, size, n)
    struct.pack_into("<3d", head, 131, scale, scale, scale)
    struct.pack_into("<3d", head, 155, *low)
    struct.pack_into("<6d", head, 179, high[0], low[0], high[1], low[1], high[2], low[2])
    return bytes(head) + out.tobytes()


class _Range(InputPartition):
    def __init__(self, path: str, first: int, count: int, header: dict):
        self.path, self.first, self.count, self.header = path, first, count, header


class _Reader(DataSourceReader):
    def __init__(self, path: str, step: int):
        self.path, self.step = path, step

    def partitions(self) -> list[_Range]:
        with open(self.path, "rb") as f:
            h = parse_header(f.read(375))
        return [_Range(self.path, k, min(self.step, h["n_points"] - k), h) for k in range(0, h["n_points"], self.step)] or [_Range(self.path, 0, 0, h)]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        h, length = part.header, part.header["record_length"]
        with open(part.path, "rb") as f:
            f.seek(h["data_offset"] + part.first * length)
            for k in range(0, part.count, 1 << 16):
                yield decode(f.read(min(1 << 16, part.count - k) * length), h, part.path, part.first + k)


class LasSource(DataSource):
    """spark.dataSource.register(LasSource); spark.read.format("las").load(path)."""

    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("range", RANGE)))


def read_las_table(files: DataFrame) -> DataFrame:
    """files(path, content) of Spark's binaryFile reader, for stores that only Spark opens; a file is one task's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = parse_header(content)
                for k in range(0, h["n_points"], 1 << 16):
                    a = h["data_offset"] + k * h["record_length"]
                    yield decode(content[a : a + min(1 << 16, h["n_points"] - k) * h["record_length"]], h, path, k)

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def crs_of(content: bytes) -> str | None:
    """The coordinate system that the variable-length records name: its WKT, or EPSG:<code> of the GeoTIFF keys (projected before
    geographic); None if none does."""
    head = parse_header(content)
    at, wkt, code = struct.unpack_from("<H", content, 94)[0], None, {}
    for _ in range(head["n_vlr"]):
        user, record, length = content[at + 2 : at + 18].rstrip(b"\0"), *struct.unpack_from("<HH", content, at + 18)
        body = content[at + 54 : at + 54 + length]
        if user == b"LASF_Projection" and record == 2112:
            wkt = body.rstrip(b"\0").decode(errors="replace")
        elif user == b"LASF_Projection" and record == 34735:
            keys = np.frombuffer(body[: len(body) // 8 * 8], "<u2").reshape(-1, 4)
            code |= {int(k): int(v) for k, place, _, v in keys[1:] if place == 0}
        at += 54 + length
    found = code.get(3072) or code.get(2048)
    return wkt or (f"EPSG:{found}" if found and found != 32767 else None)


def las_metadata(files: DataFrame) -> DataFrame:
    """One row per file of files(path, content)."""

    def run(batches):
        for batch in batches:
            rows = [{"cloud_id": p, "crs": crs_of(c), **{k: v for k, v in parse_header(c).items() if k not in ("record_length", "data_offset", "n_vlr")}} for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("cloud_id", pa.string()), ("crs", pa.string()), ("version", pa.string()), ("point_format", pa.int32()), ("n_points", pa.int64()), *((c, pa.list_(pa.float64())) for c in ("scales", "offsets", "mins", "maxs"))]))

    return files.select("path", "content").mapInArrow(run, "cloud_id string, crs string, version string, point_format int, n_points bigint, scales array<double>, offsets array<double>, mins array<double>, maxs array<double>")


def las_images(points: DataFrame, key: str = "cloud_id") -> DataFrame:
    """One LAS image per cloud: key, content. A cloud is a bounded group; larger ones are written as Parquet."""
    return points.groupBy(key).applyInPandas(lambda pdf: __import__("pandas").DataFrame({key: [pdf[key].iloc[0]], "content": [encode(pdf)]}), f"{key} string, content binary")


def list_files(spark: SparkSession, folder: str, pattern: str = "*.las", exclude: str = r"\.copc\.las$") -> DataFrame:
    """Recursive listing: path, length; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length").filter(~files["path"].rlike(exclude))


def subset(content: bytes, records: np.ndarray) -> bytes:
    """The LAS image with these records alone, in order: all their bytes (extra dimensions, too), the header's records, scales and
    offsets stay; counts and bounds follow."""
    h = parse_header(content)
    length = h["record_length"]
    raw = np.frombuffer(content, np.uint8, h["n_points"] * length, h["data_offset"]).reshape(-1, length)[np.sort(records)]
    head = bytearray(content[: h["data_offset"]])
    legacy = len(raw) if len(raw) < 1 << 32 else 0
    struct.pack_into("<I", head, 107, legacy if struct.unpack_from("<I", content, 107)[0] or h["n_points"] == 0 else 0)
    if h["version"] >= "1.4":
        struct.pack_into("<Q", head, 247, len(raw))
    xyz = np.stack([np.ascontiguousarray(raw[:, 4 * k : 4 * k + 4]).view("<i4").ravel() * h["scales"][k] + h["offsets"][k] for k in range(3)]) if len(raw) else np.zeros((3, 1))
    for k in range(3):
        struct.pack_into("<2d", head, 179 + 16 * k, xyz[k].max(), xyz[k].min())
    return bytes(head) + raw.tobytes()


def las_subsets(files: DataFrame, segments: DataFrame) -> DataFrame:
    """files(path, content) and segments(path, segment, pid: number of the record) to one image per segment: path, segment, content.
    A file is one task's, as binaryFile reads it."""
    from pyspark.sql import functions as F

    wanted = segments.groupBy("path", "segment").agg(F.collect_list(F.col("pid").cast("long")).alias("pids"))
    # all segments of a file together, so that its bytes move once
    wanted = wanted.groupBy("path").agg(F.collect_list(F.struct("segment", "pids")).alias("parts"))
    kind = segments.schema["segment"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for p in parts:
                    yield pa.record_batch({"path": pa.array([path]), "segment": pa.array([p["segment"]]), "content": pa.array([subset(content, np.array(p["pids"], np.int64))], pa.binary())})

    return files.select("path", "content").join(wanted, "path").select("path", "content", "parts").mapInArrow(run, f"path string, segment {kind.simpleString()}, content binary")
