import json
import struct

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stopwise.sources import shapes, tables
from stopwise.sources.workspace import Workspace, shared_folder


def test_weather_stations_from_csv(spark, tmp_path):
    (tmp_path / "stations.csv").write_text("Name,lat,lon,Active\nA,46.5,6.6,True\nB,46.6,6.7,False\nC,?,6.7,True\n")
    rows = {r.site: r for r in tables.read_weather_stations(spark, str(tmp_path)).collect()}
    assert (rows["A"].lat, rows["A"].lon, rows["A"].active) == (46.5, 6.6, True)
    assert rows["B"].active is False and rows["C"].lat is None


def test_weather_history_from_json(spark, tmp_path):
    document = {
        "site": "A",
        "observations": [
            {"valid_time_gmt": 1704067200, "precip_hrly": 0.5, "temp": 3},
            {"valid_time_gmt": 1704070800, "precip_hrly": None, "temp": None},
        ],
    }
    (tmp_path / "a.json").write_text(json.dumps([document], indent=2))
    rows = tables.read_weather_history(spark, str(tmp_path)).select("site", F.inline("observations")).collect()
    assert [tuple(r) for r in rows] == [("A", 1704067200, 0.5, 3), ("A", 1704070800, None, None)]


def test_malformed_and_line_wise_weather(spark, tmp_path):
    lines = ['{"site": "A", "observations": []}', '{"site": "B", "observations": [{"temp": 3}', " ", '{"site": null}', '[{"site": "C"}, {"site": "D"}]']
    (tmp_path / "lines.json").write_text("\n".join(lines))
    rows = tables.read_weather_documents(spark, str(tmp_path), one_per_line=True).collect()
    assert sorted((r.site or "") for r in rows if not r.malformed) == ["", "A", "C", "D"]
    assert [r.malformed for r in rows if r.malformed] == [lines[1]]
    assert tables.read_weather_history(spark, str(tmp_path), one_per_line=True).count() == 4


def test_model_round_trip(spark, tmp_path):
    model = spark.createDataFrame([("A", 8, False, "low", [0] * 101, 30, 0)], "stop_id string, hour int, rain boolean, temperature string, percentiles array<bigint>, sample_size bigint, level int")
    path = str(tmp_path / "model")
    tables.write_distributions(model, path)
    tables.write_distributions(model, path)
    assert tables.load_distributions(spark, path).collect() == model.collect()
    assert tables.load_distributions(spark, distributions=model) is model
    with pytest.raises(ValueError):
        tables.load_distributions(spark)


def test_schedule_tables_from_catalog_and_parquet(spark, tmp_path):
    tables.use_namespace(spark, "schedule_test")
    names = ("stops", "calendar", "trips", "routes", "stop_times", "transfers")
    for name in names:
        empty = spark.createDataFrame([], getattr(tables.schemas, name.upper()))
        empty.write.parquet(str(tmp_path / name))
        empty.write.mode("overwrite").saveAsTable(f"schedule_test.{name}")
    from_files = tables.ScheduleTables.from_parquet(spark, str(tmp_path))
    from_catalog = tables.ScheduleTables.from_catalog(spark, {n: f"schedule_test.{n}" for n in names})
    spark.sql("USE default")
    for name in names:
        assert getattr(from_files, name).schema == getattr(from_catalog, name).schema
        assert getattr(from_files, name).count() == 0


def polygon(order, *rings):
    sign = {"<": 1, ">": 0}[order]
    data = struct.pack("B", sign) + struct.pack(order + "II", 3, len(rings))
    for ring in rings:
        data += struct.pack(order + "I", len(ring))
        data += b"".join(struct.pack(order + "dd", *point) for point in ring)
    return data


OUTER = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
INNER = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]


def decode(spark, *geometries):
    rows = [(f"G{i}", "district", g) for i, g in enumerate(geometries)]
    frame = spark.createDataFrame(rows, "uuid string, level string, wkb_geometry binary")
    return [
        (r.uuid, [[(p.lon, p.lat) for p in ring] for ring in r.rings])
        for r in shapes.decode_polygons(frame).collect()
    ]


def test_polygons_from_binary(spark):
    both = b"\x00" + struct.pack(">II", 6, 2) + polygon(">", OUTER) + polygon("<", INNER)
    assert decode(spark, polygon("<", OUTER, INNER), None, both) == [
        ("G0", [OUTER, INNER]),
        ("G2", [OUTER]),
        ("G2", [INNER]),
    ]


def test_other_geometries_are_refused(spark):
    with pytest.raises(PySparkException, match="not a polygon"):
        decode(spark, b"\x01" + struct.pack("<IIdd", 1, 0, 0.0, 0.0))


def test_bounds(spark):
    frame = spark.createDataFrame([("A", "district", polygon("<", OUTER))], "uuid string, level string, wkb_geometry binary")
    row = shapes.with_bounds(shapes.decode_polygons(frame)).first()
    assert (row.min_lon, row.max_lon, row.min_lat, row.max_lat) == (0.0, 4.0, 0.0, 4.0)


def test_workspace_uses_the_shared_folder(spark):
    work = Workspace(spark)
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work.root.startswith(shared_folder(spark))
    stored, rows = work.write("part/a=1", spark.range(5))
    assert rows == stored.count() == 5
    work.write("part/a=2", spark.range(0))
    assert work.read("part/a=*", stored.schema).count() == 5
    work.drop()
    with pytest.raises(PySparkException):
        work.read("part/a=1", stored.schema).count()
