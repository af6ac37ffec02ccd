"""Binary raster and tile formats: merged meshes, elevation tiles, tile archives and their vector tiles.

Parquet is this library's own form; these readers and writers exchange files with others.  Every file is
read on its own in ``mapInPandas``; a malformed file is an error.
"""

from __future__ import annotations

import gzip
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame

# Fixed values of the formats.
MESH_MAGIC, MESH_VERSION, TILE_MAGIC = b"GM5M", 1, b"G5T1"
SIDE, NODATA, LEVEL = 256, -32768, 10
MESH = "mesh string, min_lat double, min_lon double, max_lat double, max_lon double, width int, height int"
CELL = "mesh string, row int, col int, elev float, kind tinyint, source_code tinyint"
TILE_CELL = "layer tinyint, tile_x int, tile_y int, px int, py int, meters smallint, source_code tinyint"


def mesh_header(data: bytes) -> tuple[tuple, int]:
    """Name, bounds and size of a merged mesh, and where its samples begin."""
    if data[:4] != MESH_MAGIC:
        raise ValueError("not a merged mesh")
    version, size = struct.unpack_from("<IH", data, 4)
    if version != MESH_VERSION:
        raise ValueError(f"merged mesh of version {version}")
    return (data[10 : 10 + size].decode(errors="replace"), *struct.unpack_from("<4d2I", data, 10 + size)), 50 + size


def mesh_bytes(name: str, bounds: tuple[float, float, float, float], elev: np.ndarray, kind: np.ndarray, source: np.ndarray) -> bytes:
    """A merged mesh of grids of the same shape; NaN is no elevation."""
    own = name.encode()
    head = MESH_MAGIC + struct.pack("<IH", MESH_VERSION, len(own)) + own + struct.pack("<4d2I", *bounds, elev.shape[1], elev.shape[0])
    return head + elev.astype("<f4").tobytes() + kind.astype("u1").tobytes() + source.astype("u1").tobytes()


def _each(files: DataFrame, rows, schema: str) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for data in f["content"]:
                yield rows(bytes(data))

    return files.select("content").mapInPandas(run, schema)


def mesh_headers(files: DataFrame) -> DataFrame:
    return _each(files, lambda data: pd.DataFrame([mesh_header(data)[0]]), MESH)


def mesh_cells(files: DataFrame) -> DataFrame:
    """A row for each cell of merged meshes; no elevation is null."""

    def rows(data: bytes) -> pd.DataFrame:
        (mesh, *_, width, height), at = mesh_header(data)
        n = width * height
        if len(data) < at + 6 * n:
            raise ValueError(f"merged mesh {mesh} is cut short")
        elev = pd.array(np.frombuffer(data, "<f4", n, at), "Float32")
        i = np.arange(n, dtype=np.int32)
        kind, source = (np.frombuffer(data, "u1", n, at + k * n).astype("i1") for k in (4, 5))
        elev[np.isnan(np.frombuffer(data, "<f4", n, at))] = pd.NA
        return pd.DataFrame({"mesh": mesh, "row": i // width, "col": i % width, "elev": elev, "kind": kind, "source_code": source})

    return _each(files, rows, CELL)


def tile_bytes(layer: int, tile_x: int, tile_y: int, meters: np.ndarray, source: np.ndarray) -> bytes:
    body, codes = zstandard.ZstdCompressor(level=LEVEL).compress(meters.astype("<i2").tobytes()), source.astype("u1").tobytes()
    return TILE_MAGIC + struct.pack("<BIII", layer, tile_x, tile_y, len(body)) + body + struct.pack("<I", len(codes)) + codes


def tile_parts(data: bytes) -> tuple[int, int, int, np.ndarray, np.ndarray]:
    """Layer, place, metres and source codes of a tile."""
    if data[:4] != TILE_MAGIC:
        raise ValueError("not an elevation tile")
    layer, x, y, size = struct.unpack_from("<BIII", data, 4)
    raw = zstandard.ZstdDecompressor().decompress(data[17 : 17 + size], SIDE * SIDE * 2)
    (codes,) = struct.unpack_from("<I", data, 17 + size)
    source = np.frombuffer(data[21 + size : 21 + size + codes], "u1")
    if len(raw) != SIDE * SIDE * 2 or len(source) != codes:
        raise ValueError(f"tile {x} {y} has {len(raw)} bytes of elevation and {len(source)} of sources")
    return layer, x, y, np.frombuffer(raw, "<i2"), source


def tile_cells(files: DataFrame) -> DataFrame:
    """A row for each cell with an elevation of tile files."""

    def rows(data: bytes) -> pd.DataFrame:
        layer, x, y, meters, source = tile_parts(data)
        at = np.flatnonzero(meters != NODATA).astype(np.int32)
        return pd.DataFrame({"layer": np.int8(layer), "tile_x": x, "tile_y": y, "px": at % SIDE, "py": at // SIDE, "meters": meters[at], "source_code": source[at].astype("i1")}).astype({"tile_x": "int32", "tile_y": "int32"})

    return _each(files, rows, TILE_CELL)


def tile_files(cells: DataFrame) -> DataFrame:
    """layer, tile_x, tile_y and the file's bytes of each tile of cells; a group has 65,536 cells at most."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        meters, source = np.full(SIDE * SIDE, NODATA, np.int16), np.zeros(SIDE * SIDE, np.uint8)
        group = group[group["meters"].notna()]
        at = (group["py"] * SIDE + group["px"]).to_numpy(np.int64)
        meters[at], source[at] = group["meters"].to_numpy(np.int16), group["source_code"].to_numpy(np.uint8)
        return pd.DataFrame({"layer": [key[0]], "tile_x": [key[1]], "tile_y": [key[2]], "content": [tile_bytes(*map(int, key), meters, source)]})

    return cells.groupBy("layer", "tile_x", "tile_y").applyInPandas(pack, "layer tinyint, tile_x int, tile_y int, content binary")


# Tile archives and vector tiles


def varints(data: bytes) -> Iterator[int]:
    value = shift = 0
    for b in data:
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            yield value
            value = shift = 0


def directory(data: bytes, gzipped: bool = False) -> list[tuple[int, int, int, int]]:
    """Tile id, run length, offset and length of each entry; an offset of 0 follows the entry before it."""
    numbers = varints(gzip.decompress(data) if gzipped else data)
    n = next(numbers)
    steps, runs, lengths, places = ([next(numbers) for _ in range(n)] for _ in range(4))
    out, tile, end = [], 0, 0
    for step, run, length, place in zip(steps, runs, lengths, places):
        tile += step
        start = place - 1 if place or not out else end
        end = start + length
        out.append((tile, run, start, length))
    return out


def messages(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message: an integer, or bytes."""
    at = 0

    def integer() -> int:
        nonlocal at
        end = next(i for i in range(at, len(data)) if data[i] < 128) + 1
        value = next(varints(data[at:end]))
        at = end
        return value

    while at < len(data):
        number, wire = divmod(integer(), 8)
        if wire == 0:
            yield number, integer()
            continue
        size = {1: 8, 5: 4}.get(wire) if wire != 2 else integer()
        if size is None:
            raise ValueError(f"wire type {wire}")
        yield number, data[at : at + size]
        at += size


def _value(data: bytes) -> str | int | bool | None:
    """A value of a layer; floats are left out."""
    for number, x in messages(data):
        if number == 1:
            return x.decode(errors="replace")
        if number in (4, 5):
            return x
        if number in (6, 7):
            return (x >> 1) ^ -(x & 1) if number == 6 else bool(x)
    return None


def tile_features(data: bytes) -> list[tuple[str, dict]]:
    """Layer and properties of each feature of a vector tile, gzipped or plain."""
    out = []
    for number, layer in messages(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
        if number != 3:
            continue
        parts: dict[int, list] = {k: [] for k in range(1, 16)}
        for k, x in messages(layer):
            parts.setdefault(k, []).append(x)
        keys, values = [x.decode(errors="replace") for x in parts[3]], [_value(x) for x in parts[4]]
        for feature in parts[2]:
            tags = [list(varints(x)) for k, x in messages(feature) if k == 2]
            pairs = [p for t in tags for p in zip(t[::2], t[1::2])]
            out.append((parts[1][0].decode() if parts[1] else "", {keys[k]: values[v] for k, v in pairs if k < len(keys) and v < len(values)}))
    return out


def feature_rows(tiles: DataFrame) -> DataFrame:
    """layer and properties (as strings) of every feature of vector tiles (tile_id, content)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for tile, data in zip(f["tile_id"], f["content"]):
                rows = [(tile, layer, {k: None if v is None else str(v) for k, v in own.items()}) for layer, own in tile_features(bytes(data))]
                if rows:
                    yield pd.DataFrame(rows, columns=["tile_id", "layer", "properties"])

    return tiles.select("tile_id", "content").mapInPandas(run, "tile_id long, layer string, properties map<string,string>")
