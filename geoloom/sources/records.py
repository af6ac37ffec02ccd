"""JSON lines and GeoJSON in and out."""

from __future__ import annotations

import os
from xml.sax.saxutils import escape

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def point_lines(lines: DataFrame) -> DataFrame:
    """value, ord, lat, lon of JSON lines (ord, value); blank lines go, bad ones are errors with their line.

    The text is kept, so that any further fields come out as they came in.
    """
    rows = lines.where(F.trim("value") != "").withColumn("_v", F.try_parse_json("value"))
    at = lambda k: F.try_variant_get("_v", f"$.{k}", "double")
    bad = F.concat(F.lit("line "), (F.col("ord") + 1).cast("string"), F.lit(": needs an object with numbers lat and lon"))
    good = F.assert_true(at("lat").isNotNull() & at("lon").isNotNull(), bad)
    return rows.select("ord", "value", at("lat").alias("lat"), at("lon").alias("lon"), good.alias("_ok")).where("_ok IS NULL").drop("_ok")


def with_fields(rows: DataFrame, *names: str) -> DataFrame:
    """value with further fields added at the end of its object; nulls are written as null."""
    added = F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), F.coalesce(F.col(n).cast("string"), F.lit("null"))) for n in names])
    body = F.regexp_replace(F.rtrim("value"), "\\s*\\}$", "")
    return rows.withColumn("value", F.concat(body, F.when(body.rlike("\\{\\s*$"), "").otherwise(","), added, F.lit("}")))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """ord and the columns of schema of JSON lines; ord rises in file order.  Blank lines go, bad ones are errors."""
    rows = spark.read.text(path).where(F.trim("value") != "").withColumn("ord", F.monotonically_increasing_id())
    return rows.select("ord", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("ord", "r.*")


GOLDEN = "tolerance_m struct<dem5: double, dem10: double>, points array<struct<name: string, lat: double, lon: double, expected_m: double, layer: string>>"


def golden_points(spark: SparkSession, path: str) -> DataFrame:
    """ord, name, lat, lon, expected_m, expected_layer and tolerance_m of a golden document; a field that is missing is an error."""
    doc = spark.read.schema(GOLDEN).option("mode", "FAILFAST").json(path, multiLine=True)
    p = doc.select("tolerance_m", F.posexplode("points").alias("ord", "p")).select("ord", "p.name", "p.lat", "p.lon", "p.expected_m", F.col("p.layer").alias("expected_layer"), "tolerance_m")
    limit = F.when(F.col("expected_layer") == "dem5", F.col("tolerance_m.dem5")).otherwise(F.col("tolerance_m.dem10"))
    whole = F.col("name").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("expected_m").isNotNull() & F.col("expected_layer").isin("dem5", "dem10") & limit.isNotNull()
    return p.where(F.assert_true(F.coalesce(whole, F.lit(False)), F.concat(F.lit("bad golden point "), F.col("ord").cast("string"))).isNull()).withColumn("tolerance_m", limit)


FEATURES = "type string, features array<struct<properties: struct<route_id: string, segment_id: string>, geometry: struct<type: string, coordinates: array<array<double>>>>>"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """ord, route_id, segment_id, coordinates of a FeatureCollection of LineStrings, checked."""
    doc = spark.read.schema(FEATURES).json(path, multiLine=True)
    f = doc.select(F.posexplode("features").alias("ord", "f")).select("ord", "f.properties.route_id", "f.properties.segment_id", "f.geometry")
    pairs_ok = F.forall("geometry.coordinates", lambda p: (F.size(p) >= 2) & p[0].between(-180, 180) & p[1].between(-90, 90))
    ok = F.coalesce((F.col("route_id") != "") & (F.col("geometry.type") == "LineString") & (F.size("geometry.coordinates") >= 2) & pairs_ok, F.lit(False))
    return f.where(F.assert_true(ok, F.concat(F.lit("bad feature "), F.col("ord").cast("string"))).isNull()).select("ord", "route_id", "segment_id", F.col("geometry.coordinates").alias("coordinates"))


def vertices(lines: DataFrame) -> DataFrame:
    return lines.select("ord", "route_id", "segment_id", F.posexplode("coordinates").alias("v", "p")).select(F.col("ord").alias("line"), "route_id", "segment_id", F.col("v").alias("ord"), F.col("p")[1].alias("lat"), F.col("p")[0].alias("lon"))


def point_features(rows: DataFrame, *properties: str) -> DataFrame:
    """GeoJSON point features (a JSON text each) of rows with valid lat and lon."""
    lat, lon = F.col("lat").try_cast("double"), F.col("lon").try_cast("double")
    shape = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*properties).alias("properties"))
    return rows.where(lat.between(-90, 90) & lon.between(-180, 180)).select("ord", F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))


def raw_raster(cells: DataFrame, path: str) -> dict:
    """Int16 raster of one layer's cells, missing ones -32768, its north-west corner at the least tile.

    Bands of one tile row come to the driver one after another, in order; a band is all it holds.
    """
    e = cells.agg(F.min("tile_x"), F.max("tile_x"), F.min("tile_y"), F.max("tile_y")).first()
    if e[0] is None:
        raise ValueError("no tile")
    if os.path.exists(path):
        raise FileExistsError(path)
    width, height = int(e[1] - e[0] + 1) * 256, int(e[3] - e[2] + 1) * 256
    with open(path, "wb") as out:
        for ty in range(int(e[2]), int(e[3]) + 1):
            band = np.full((256, width), -32768, "<i2")
            rows = cells.where(F.col("tile_y") == ty).select(((F.col("tile_x") - int(e[0])) * 256 + F.col("px")).alias("x"), "py", "meters").toPandas()
            band[rows["py"], rows["x"]] = rows["meters"]
            out.write(band.tobytes())
    return {"width": width, "height": height, "min_tile_x": int(e[0]), "min_tile_y": int(e[2])}


def vrt(name: str, shape: dict, grid: dict) -> str:
    """The VRT document of a raw raster."""
    west = grid["origin_lon"] + shape["min_tile_x"] * 256 * grid["step_lon"]
    north = grid["origin_lat"] - shape["min_tile_y"] * 256 * grid["step_lat"]
    transform = ", ".join(repr(float(v)) for v in (west, grid["step_lon"], 0, north, 0, -grid["step_lat"]))
    return (
        f'<VRTDataset rasterXSize="{shape["width"]}" rasterYSize="{shape["height"]}">\n  <SRS>EPSG:4326</SRS>\n  <GeoTransform>{transform}</GeoTransform>\n'
        f'  <VRTRasterBand dataType="Int16" band="1" subClass="VRTRawRasterBand">\n    <NoDataValue>-32768</NoDataValue>\n'
        f'    <SourceFilename relativeToVRT="1">{escape(name)}</SourceFilename>\n    <ImageOffset>0</ImageOffset>\n    <PixelOffset>2</PixelOffset>\n'
        f"    <LineOffset>{2 * shape['width']}</LineOffset>\n    <ByteOrder>LSB</ByteOrder>\n  </VRTRasterBand>\n</VRTDataset>\n"
    )
