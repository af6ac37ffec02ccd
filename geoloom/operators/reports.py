"""Counts and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def warning_examples(warnings: DataFrame, most: int = 5) -> DataFrame:
    """code, n and the first ``most`` distinct ids, of warnings (ord, code, id)."""
    first = warnings.groupBy("code", "id").agg(F.min("ord").alias("ord"), F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("code").orderBy("ord"))
    few = first.withColumn("rn", rank).where(F.col("rn") <= most)  # a group limit runs before the shuffle
    ids = few.groupBy("code").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "id"))), lambda s: s.id).alias("examples"))
    return warnings.groupBy("code").agg(F.count("*").alias("n")).join(ids, "code")


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def top_values(rows: DataFrame, column: str, most: int) -> DataFrame:
    return histogram(rows, column).orderBy(F.col("n").desc(), "value").limit(most)


def map_key_counts(rows: DataFrame, column: str, most: int) -> DataFrame:
    return top_values(rows.select(F.explode(F.map_keys(column)).alias("key")), "key", most)


def field_coverage(rows: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Rows that hold a non-empty value for each key of a map column."""
    return rows.agg(*[F.count_if(F.coalesce(F.try_element_at(column, F.lit(k)), F.lit("")) != "").alias(k) for k in keys])


def coverage(rows: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return rows.agg(F.count("*").alias("total"), *[F.count_if(c).alias(name) for name, c in measures.items()])


def totals(rows: DataFrame, by: str, measures: dict[str, Column]) -> DataFrame:
    """Counters by a column and in total (null), zeros where nothing counts."""
    return rows.rollup(by).agg(*[F.count_if(c).alias(name) for name, c in measures.items()])


def missing_numbers(rows: DataFrame, column: str, first: int, last: int) -> DataFrame:
    spark = rows.sparkSession
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("number")).join(rows.select(F.col(column).cast("int").alias("number")), "number", "left_anti")


def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def numbered(rows: DataFrame, by: str, order: str, form: str, name: str = "label") -> DataFrame:
    """A label such as ``R_L001`` by the place of a row in its group."""
    n = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return rows.withColumn(name, F.concat(F.col(by).cast("string"), F.format_string(form, n)))


def violations(checks: dict[str, DataFrame]) -> DataFrame:
    """rule and n of every check that finds rows."""
    out = None
    for rule, found in checks.items():
        one = found.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n")
        out = one if out is None else out.unionAll(one)
    return out.where("n > 0")


def record_stats(records: DataFrame) -> DataFrame:
    """One row over records (name, prefecture, table_kind, has_detail): counts, repeated names, maps by prefecture and kind."""
    names = records.groupBy("name").agg(F.count("*").alias("n"))
    repeated = names.where("n > 1").agg(F.count("*").alias("repeated_names"), F.coalesce(F.sum("n"), F.lit(0)).alias("repeated_listings"))
    counts = records.agg(F.count("*").alias("records"), F.count_if("has_detail").alias("with_detail"), F.count_if(~F.col("has_detail")).alias("without_detail"), F.count_if(F.col("table_kind") == "temple").alias("temple"), F.count_if(F.col("table_kind") == "route").alias("route"))
    total = names.agg(F.count("*").alias("distinct_names"))
    return counts.join(F.broadcast(total)).join(F.broadcast(repeated))  # one row each


def manifest_summary(index: DataFrame) -> DataFrame:
    """One row over index records (prefecture, closure_marker, temple_number): counts and the temple numbers in order."""
    return index.agg(
        F.count("*").alias("record_count"), F.countDistinct("prefecture").alias("prefectures"), F.count_if(F.coalesce("closure_marker", F.lit("")) != "").alias("closure_marker_count"),
        F.array_join(F.array_sort(F.collect_set("temple_number")).cast("array<string>"), ",").alias("temple_numbers"),
    )


def status_counts(rows: DataFrame, *statuses: str) -> DataFrame:
    """One row: how many rows have each status, and all others."""
    return rows.agg(*[F.count_if(F.col("status") == s).alias(s) for s in statuses], F.count_if(~F.coalesce(F.col("status").isin(*statuses), F.lit(False))).alias("other"))


def dataset_summary(courses: DataFrame, warnings: DataFrame) -> DataFrame:
    """One row over normalized courses (photo_point, tourism_spots, placemarks) and warnings."""
    size = lambda c: F.coalesce(F.sum(F.greatest(F.size(c), F.lit(0))), F.lit(0))
    own = courses.agg(F.count("*").alias("course_count"), F.count_if(F.col("photo_point").isNotNull()).alias("photo_point_count"), size("tourism_spots").alias("tourism_spot_count"), size("placemarks").alias("placemark_count"))
    return own.join(F.broadcast(warnings.agg(F.count("*").alias("warning_count"))))  # one row each


def accounting(counters: DataFrame) -> DataFrame:
    """Rules that trail counters (a row for each prefecture and the total) break: rule, n."""
    c = F.col
    rules = {
        "no route": c("route_segments") < c("courses"),
        "spots": c("linked_tourism_spots") + c("unmatched_tourism_spots") != c("tourism_spots"),
        "points": c("route_coordinate_points") < 2 * c("route_segments"),
    }
    broken = F.explode(F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()])))
    return counters.select(broken.alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def archive_listing(rasters: DataFrame) -> DataFrame:
    """Meshes of archives (path, mesh, source_code, width, height, stored) in order, with totals at the end (mesh null)."""
    full = F.col("stored") == F.col("width") * F.col("height")
    return rasters.rollup("mesh").agg(F.count("*").alias("rasters"), F.sum("stored").alias("stored"), F.sum(F.col("width") * F.col("height")).alias("cells"), F.count_if(~full).alias("partial")).orderBy(F.col("mesh").asc_nulls_last())


def by_number(rows: DataFrame, column: str, *ties: str) -> DataFrame:
    """Rows in the order of a column's numbers, with their place; texts that are no number come last, equal texts by ``ties``."""
    return rows.withColumn("place", F.row_number().over(Window.orderBy(F.col(column).try_cast("long").asc_nulls_last(), column, *ties)))
