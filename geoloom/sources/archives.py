"""Readers of files that Spark has no format for: zipped GML rasters, HTML pages, KML.

Bytes come through Spark's ``binaryFile`` source, so any store that Spark reads will do; parsing runs in
``mapInPandas``, a file at a time.
"""

from __future__ import annotations

import html
import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries beyond this size are refused, and what a tuple's label stands for.
MOST_BYTES = 64 << 20
LABELS = {"地表面": 1, "表層面": 1, "海水面": 2, "内水面": 3, "海水底面": 4, "内水底面": 5, "データなし": 0}
OTHER, MISSING = "その他", ("-9999", "-9999.00")


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "content")


def region_of(path: Column) -> Column:
    """First six digits of a file's name, null where there are fewer."""
    digits = F.regexp_replace(F.element_at(F.split(path, "/"), -1), "[^0-9]", "")
    return F.when(F.length(digits) >= 6, F.substring(digits, 1, 6))


def one_per_region(archives: DataFrame) -> DataFrame:
    """archives with region, failing where a region has two."""
    rows = archives.withColumn("region", region_of(F.col("path")))
    twice = rows.groupBy("region").agg(F.count("*").alias("n"))
    return rows.join(twice, "region").where(F.assert_true(F.col("n") == 1, F.concat(F.lit("two archives for region "), F.col("region"))).isNull()).drop("n")


def fine_archives(archives: DataFrame) -> DataFrame:
    """region and paths (in order) of archives that name a region and are not of the coarse product."""
    rows = archives.select("path", region_of(F.col("path")).alias("region")).where(~F.upper(F.element_at(F.split("path", "/"), -1)).contains("DEM10B") & F.col("region").isNotNull())
    return rows.groupBy("region").agg(F.array_sort(F.collect_list("path")).alias("paths"))  # a few files a region


def coarse_rasters(archives: DataFrame, meta_only: bool = False) -> DataFrame:
    """region and the raster of the first XML entry of each region's one coarse archive; with meta_only its bounds and size alone."""
    coarse = archives.where(F.upper(F.element_at(F.split("path", "/"), -1)).contains("DEM10B"))
    entries = xml_entries(one_per_region(coarse).drop("region"))
    first = entries.groupBy("path").agg(F.min_by(F.struct("entry", "content"), "entry").alias("e")).select("path", "e.entry", "e.content")
    return dem_rasters(first, meta_only).withColumn("region", region_of(F.col("path")))


def xml_entries(archives: DataFrame) -> DataFrame:
    """path, entry, content of the XML entries, those of nested archives too."""

    def walk(path: str, data: bytes, prefix: str = "") -> Iterator[tuple[str, str, bytes]]:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for info in z.infolist():
                name = info.filename.lower()
                if not name.endswith((".xml", ".zip")):
                    continue
                if info.file_size > MOST_BYTES:
                    raise ValueError(f"{path}: {info.filename} has over {MOST_BYTES} bytes")
                if name.endswith(".xml"):
                    yield path, prefix + info.filename, z.read(info)
                else:
                    yield from walk(path, z.read(info), f"{prefix}{info.filename}!")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, data in zip(f["path"], f["content"]):
                for row in walk(path, data):
                    yield pd.DataFrame([row], columns=["path", "entry", "content"])

    return archives.mapInPandas(run, "path string, entry string, content binary")


def sample_of(label: str, value: str) -> tuple[float | None, int]:
    """Height and kind of a tuple; unknown labels and bad numbers are errors."""
    text = value.strip()
    if label == OTHER:
        kind = 0 if text.rstrip(".") in MISSING else 1
    elif label in LABELS:
        kind = LABELS[label]
    else:
        raise ValueError(f"unknown label {label!r}")
    if kind == 0:
        return None, 0
    return (0.0 if kind == 2 else float(text.rstrip("."))), kind


def _numbers(text: str | None) -> tuple[float, float]:
    def number(t: str) -> float:
        try:
            return float(t)
        except ValueError:
            return 0.0

    parts = (text or "").split()
    return number(parts[0]) if parts else 0.0, number(parts[1]) if len(parts) > 1 else 0.0


def parse_dem(data: bytes, meta_only: bool = False) -> dict:
    """One raster: scalars, and unless meta_only the stored heights and kinds in file order."""
    head = data[:200].lower()
    if b"shift_jis" in head or b"shift-jis" in head or b"sjis" in head:
        data = re.sub(rb"encoding=[\"'][^\"']+[\"']", b'encoding="utf-8"', data.decode("cp932").encode(), count=1)
    got: dict = {"mesh": None, "survey_date": None, "crs": None, "low": (0, 0), "high": (0, 0), "start": (0, 0), "lower": (0.0, 0.0), "upper": (0.0, 0.0), "order": None, "sequence": None}
    tuples = ""
    for event, e in ET.iterparse(io.BytesIO(data), ("start", "end")):
        name, text = e.tag.rpartition("}")[2], (e.text or "").strip()
        if event == "start":
            if name == "Envelope":
                got["crs"] = e.get("srsName")
            if name == "tupleList" and meta_only:
                break
            continue
        if name == "mesh":
            got["mesh"] = text
        elif name == "timePosition" and text and not got["survey_date"] or name in ("lfSpanFr", "devDate") and text and not got["survey_date"]:
            got["survey_date"] = text
        elif name == "lowerCorner":
            got["lower"] = _numbers(text)
        elif name == "upperCorner":
            got["upper"] = _numbers(text)
        elif name in ("low", "high"):
            got[name] = tuple(int(v) for v in _numbers(text))
        elif name == "startPoint":
            got["start"] = tuple(int(v) for v in _numbers(text))
        elif name == "sequenceRule":
            got["order"], got["sequence"] = e.get("order"), text
        elif name == "tupleList":
            tuples = e.text or ""
    width, height = (int(got["high"][i] - got["low"][i] + 1) for i in (0, 1))
    samples = [sample_of(*line.strip().split(",", 1)) for line in tuples.splitlines() if line.strip()]
    return {
        "mesh": got["mesh"], "survey_date": got["survey_date"], "crs": got["crs"], "width": width, "height": height, "start_x": int(got["start"][0]), "start_y": int(got["start"][1]),
        "min_lat": got["lower"][0], "min_lon": got["lower"][1], "max_lat": got["upper"][0], "max_lon": got["upper"][1], "sequence_order": got["order"], "sequence": got["sequence"],
        "elev": [s[0] for s in samples], "kind": [s[1] for s in samples],
    }


RASTER = "path string, entry string, mesh string, survey_date string, crs string, width int, height int, start_x int, start_y int, min_lat double, min_lon double, max_lat double, max_lon double, sequence_order string, sequence string, elev array<float>, kind array<tinyint>"


def dem_rasters(entries: DataFrame, meta_only: bool = False) -> DataFrame:
    """A row for each raster of xml_entries."""
    names = [c.split()[0] for c in RASTER.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, entry, data in zip(f["path"], f["entry"], f["content"]):
                row = {"path": path, "entry": entry, **parse_dem(data, meta_only)}
                yield pd.DataFrame([[row[n] for n in names]], columns=names)

    return entries.mapInPandas(run, RASTER)


def dem_cells(rasters: DataFrame) -> DataFrame:
    """dem_cell rows of rasters that have a source_code, by the order rule of their samples."""
    from ..functions import geo

    one = rasters.select("mesh", "source_code", "width", "start_x", "start_y", F.posexplode(F.arrays_zip("elev", "kind")).alias("i", "s"))
    return one.select("mesh", "source_code", geo.stored_row(F.col("i"), F.col("start_x"), F.col("start_y"), F.col("width")).alias("row"), geo.stored_col(F.col("i"), F.col("start_x"), F.col("width")).alias("col"), F.col("s.elev").alias("elev"), F.col("s.kind").alias("kind"))


# HTML


class _Nodes(HTMLParser):
    """Flat list of elements in document order: tag, attributes, text inside, and the open elements above."""

    VOID = ("br", "img", "hr", "meta", "link", "input", "iframe")

    def __init__(self, wanted: tuple[str, ...] | None = None):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted
        self.nodes: list[dict] = []
        self.open: list[int] = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.handle_data("\n")
        self.nodes.append({"tag": tag, "attrs": {k: v or "" for k, v in attrs}, "text": [], "parent": self.open[-1] if self.open else -1})
        if tag not in self.VOID:
            self.open.append(len(self.nodes) - 1)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[i]]["tag"] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        for i in self.open:
            if self.wanted is None or self.nodes[i]["tag"] in self.wanted:
                self.nodes[i]["text"].append(data)


NODE = "ord int, tag string, parent int, attrs map<string,string>, text string"


def html_nodes(page: str, tags: tuple[str, ...] | None = None) -> list[tuple]:
    """The elements of a page (those of some tags) in document order; texts are gathered for these alone."""
    parser = _Nodes(tags)
    parser.feed(page or "")
    clean = lambda t: "\n".join(x for x in (re.sub(r"[ \t\r\f\v　]+", " ", y).strip() for y in t.split("\n")) if x)
    return [(i, n["tag"], n["parent"], n["attrs"], clean("".join(n["text"]))) for i, n in enumerate(parser.nodes) if tags is None or n["tag"] in tags]


#: Elements that go to Spark in one batch.
TOGETHER = 20_000


def page_nodes(pages: DataFrame, key: str, column: str, tags: tuple[str, ...] | None = None) -> DataFrame:
    """key and NODE columns, one row for each element (of some tags) of every page in document order."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def sent() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 6
            rows.clear()
            types = [None, pa.int32(), pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.string()]
            attrs = [list(x.items()) for x in columns[4]]
            return pa.RecordBatch.from_arrays([pa.array(attrs if i == 4 else c, key_type if i == 0 else t) for i, (c, t) in enumerate(zip(columns, types))], names=[key, "ord", "tag", "parent", "attrs", "text"])

        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [(k, *n) for n in html_nodes(page, tags)]
                if len(rows) >= TOGETHER:
                    yield sent()
        if rows:
            yield sent()

    return pages.select(key, column).mapInArrow(run, f"{key} {kind}, {NODE}")


def page_links(nodes: DataFrame, key: str) -> DataFrame:
    return nodes.where("tag = 'a'").select(key, "ord", F.try_element_at("attrs", F.lit("href")).alias("href"), "text").where("href IS NOT NULL")


def page_tables(nodes: DataFrame, key: str) -> DataFrame:
    """Rows of tables: the texts of the cells of each tr, in order."""
    cells = nodes.where("tag IN ('td', 'th')").select(key, F.col("parent").alias("row"), "ord", "text")
    return cells.groupBy(key, "row").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "text"))), lambda c: c.text).alias("cells"))


def script_array(page: Column, name: str) -> Column:
    """The JSON text of ``var name = [...]`` in a page's script."""
    return F.nullif(F.regexp_extract(page, f"(?s)var {name} = (\\[.*?\\]);", 1), F.lit(""))


SPOT = "array<struct<Spot: map<string,string>, SpotContent: map<string,string>>>"


def script_spots(pages: DataFrame, column: str = "html", category: str = "3") -> DataFrame:
    """spot and content of the spots of one category in the pages' ``spots`` array; a page without one is an error."""
    array = script_array(F.col(column), "spots")
    found = pages.where(F.assert_true(array.isNotNull(), F.lit("a page has no spots array")).isNull()).select(F.explode(F.from_json(array, SPOT)).alias("s"))
    return found.where(F.try_element_at("s.Spot", F.lit("spot_category_id")) == category).select(F.col("s.Spot").alias("spot"), F.col("s.SpotContent").alias("content"))


# KML


def plain_text(text: str | None) -> str | None:
    if text is None:
        return None
    return html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"(?i)<br\s*/?>", "\n", text))).strip() or None


def parse_kml(data: bytes) -> list[tuple]:
    """name, description and flattened geometry of each placemark; malformed files are errors."""
    try:
        root = ET.fromstring(data)
    except ET.ParseError as e:
        raise ValueError(f"malformed KML: {e}") from e
    local = lambda e: e.tag.rpartition("}")[2]
    out = []
    for mark in (e for e in root.iter() if local(e) == "Placemark"):
        child = {local(e): e for e in mark}
        shapes = []
        for shape in (e for e in mark.iter() if local(e) in ("Point", "LineString")):
            text = next((e.text or "" for e in shape.iter() if local(e) == "coordinates"), "")
            points = [[float(v) for v in p.split(",")] for p in text.split()]
            shapes.append({"kind": local(shape), "coordinates": points})
        name = child["name"].text if "name" in child else None
        out.append((name.strip() if name else None, plain_text(child["description"].text if "description" in child else None), shapes))
    return out


def placemarks(kml_files: DataFrame) -> DataFrame:
    """A row for each placemark; a file that does not parse gives one row with its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, data in zip(f["path"], f["content"]):
                try:
                    rows = [(path, i, *m, None) for i, m in enumerate(parse_kml(data))]
                except ValueError as e:
                    rows = [(path, 0, None, None, [], str(e))]
                if rows:
                    yield pd.DataFrame(rows, columns=["path", "ord", "name", "description", "geometry", "error"])

    return kml_files.mapInPandas(run, "path string, ord int, name string, description string, geometry array<struct<kind:string,coordinates:array<array<double>>>>, error string")
