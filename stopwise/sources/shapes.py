"""Region polygons from well-known binary."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RING = "array<struct<lon: double, lat: double>>"
POLYGONS = f"uuid string, level string, rings array<{RING}>"

# Geometry codes of the well-known binary format.
POLYGON_CODE = 3
MULTI_POLYGON_CODE = 6


def _read_polygons(wkb: bytes) -> list[list[list[tuple[float, float]]]]:
    """Polygons of one geometry, each a list of rings of ``(lon, lat)``."""
    position = 0

    def take(layout: str, order: str) -> tuple:
        nonlocal position
        values = struct.unpack_from(order + layout, wkb, position)
        position += struct.calcsize(order + layout)
        return values

    def geometry() -> list:
        order = "<" if take("B", "=")[0] == 1 else ">"
        code, count = take("II", order)
        if code == MULTI_POLYGON_CODE:
            return [polygon for _ in range(count) for polygon in geometry()]
        if code != POLYGON_CODE:
            raise ValueError(f"geometry code {code} is not a polygon")
        rings = []
        for _ in range(count):
            (size,) = take("I", order)
            flat = take(f"{2 * size}d", order)
            rings.append(list(zip(flat[::2], flat[1::2])))
        return [rings]

    return geometry()


def _decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    point = pa.struct([("lon", pa.float64()), ("lat", pa.float64())])
    layout = pa.schema(
        [("uuid", pa.string()), ("level", pa.string()), ("rings", pa.list_(pa.list_(point)))]
    )
    for batch in batches:
        rows = [
            {
                "uuid": row["uuid"],
                "level": row["level"],
                "rings": [[{"lon": x, "lat": y} for x, y in ring] for ring in polygon],
            }
            for row in batch.to_pylist()
            if row["wkb_geometry"] is not None
            for polygon in _read_polygons(row["wkb_geometry"])
        ]
        yield pa.RecordBatch.from_pylist(rows, schema=layout)


def decode_polygons(shapes: DataFrame) -> DataFrame:
    """One row per polygon of ``(uuid, level, wkb_geometry)``; first ring outer, others holes."""
    return shapes.select("uuid", "level", "wkb_geometry").mapInArrow(_decode, POLYGONS)


def with_bounds(polygons: DataFrame) -> DataFrame:
    """Add the bounding box of each polygon."""
    outer = F.get("rings", F.lit(0))
    lon, lat = F.transform(outer, lambda p: p.lon), F.transform(outer, lambda p: p.lat)
    return polygons.withColumns(
        {
            "min_lon": F.array_min(lon),
            "max_lon": F.array_max(lon),
            "min_lat": F.array_min(lat),
            "max_lat": F.array_max(lat),
        }
    )
