"""Series pointer files and the wide CSV files they point to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.series import normalize_series

# A cell and the comma before it: runs outside quotes, and quotes, which may hold commas. Possessive, so that a line is read once.
_CELL = r',([^",]*+(?:"[^"]*+"?[^",]*+)*+)'

# Fields of a pointer row, in file order.
POINTER_SCHEMA = (
    "simulation string, category string, module string, type string, component_name string, name string, "
    "resolution int, scaling_factor_multiplier string, scaling_factor_multiplier_module string, "
    "normalization_factor string, data_file string"
)


def build_ts_pointers(
    series_ids: DataFrame,
    names: DataFrame,
    factors: DataFrame,
    category: str,
    data_file: str,
    module: str,
    multiplier_module: str,
    label: str = "max_active_power",
    multiplier: str = "get_max_active_power",
    resolution: int = 3600,
    simulation: str = "DA",
) -> DataFrame:
    """One pointer row per series whose id belongs to a known component.

    `series_ids(series_id)`, `names(series_id, component_name)`, `factors(series_id, factor)`.
    """
    known = series_ids.select("series_id").distinct().join(names, "series_id").join(factors, "series_id")
    return known.select(
        F.lit(simulation).alias("simulation"),
        F.lit(category).alias("category"),
        F.lit(module).alias("module"),
        F.lit("SingleTimeSeries").alias("type"),
        F.col("component_name"),
        F.lit(label).alias("name"),
        F.lit(resolution).alias("resolution"),
        F.lit(multiplier).alias("scaling_factor_multiplier"),
        F.lit(multiplier_module).alias("scaling_factor_multiplier_module"),
        F.col("factor").cast("string").alias("normalization_factor"),
        F.lit(data_file).alias("data_file"),
    )


def write_ts_pointers(pointers: DataFrame, path: str, mode: str = "overwrite") -> None:
    pointers.write.mode(mode).json(path)


def _cells(line: Column) -> Column:
    """Cells of a CSV line, quotes taken off; a quote that is not closed reaches to the end of the line."""
    line = F.regexp_replace(line, "\r$", "")
    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1)), lambda c: F.regexp_replace(F.trim(c), '^"(.*)"$', "$1"))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.transform(F.split(line, ","), lambda c: F.trim(c)))


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    text = spark.read.text(paths if isinstance(paths, str) else list(paths), recursiveFileLookup=True)
    return text.select(F.regexp_replace("_metadata.file_path", "^file:/*", "/").alias("file"), "value")


def _headers(lines: DataFrame, time_header: str) -> DataFrame:
    """(file, names): the header line of each file, known by its time column."""
    names = _cells(F.col("value"))
    return lines.select("file", names.alias("names")).where(F.array_contains("names", time_header)).dropDuplicates(["file"])


def _stamp(time_header: str) -> Column:
    """The number of the time column in `names`, counted from zero."""
    return F.array_position("names", F.lit(time_header)).cast("int") - 1


def read_wide_series(spark: SparkSession, paths: str | Sequence[str], time_header: str = "DateTime") -> DataFrame:
    """Long rows (data_file, component_name, ts, value) of wide CSV files or folders of parts.

    All files are one scan, whatever their columns are: a file's header is one of its lines, and rows meet it by
    the file's name. Files without the time column in a header give no rows.
    """
    lines = _lines(spark, paths)
    headers = _headers(lines, time_header).select("file", "names", _stamp(time_header).alias("stamp"))
    rows = lines.join(headers, "file").select("file", "names", "stamp", _cells(F.col("value")).alias("cells")).where(F.get("cells", "stamp") != time_header)
    zipped = F.arrays_zip(F.col("names"), F.col("cells"))
    ts = F.get("cells", "stamp").try_cast("timestamp_ntz").alias("ts")
    cells = rows.select("file", ts, F.explode(F.filter(zipped, lambda c: c["names"] != time_header)).alias("cell"))
    return cells.select(F.col("file").alias("data_file"), F.col("cell.names").alias("component_name"), "ts", F.col("cell.cells").try_cast("double").alias("value"))


_KEPT = ("simulation", "category", "type", "name", "resolution", "scaling_factor_multiplier", "normalization_factor")


def _pointed_lines(spark: SparkSession, data_root: str, pointers: DataFrame, time_header: str) -> DataFrame:
    """(ts, cells, wanted): the lines of files that pointers name; `wanted` has the place in `cells` of each pointer of the file.

    The places are found once per file, from its header. A pointer of a column that the file lacks is left out.
    """
    place = F.regexp_replace(F.regexp_replace("data_file", "^file:/*", "/"), "/$", "")
    pointers = pointers.withColumn("data_file", place)
    lines = _lines(spark, data_root)
    headers = _headers(lines, time_header)
    parent = F.regexp_replace("file", "/[^/]*$", "")
    columns = headers.select("file", _stamp(time_header).alias("stamp"), F.explode(F.array("file", parent)).alias("data_file"), "names")
    columns = columns.select("file", "stamp", "data_file", F.posexplode("names").alias("place", "component_name")).where(F.col("place") != F.col("stamp"))
    # A file with the same name in several columns has the pointer for each of them.
    known = columns.join(pointers, ["data_file", "component_name"]).groupBy("file", "stamp").agg(F.collect_list(F.struct("place", "component_name", *_KEPT)).alias("wanted"))
    rows = lines.join(known, "file").select("stamp", "wanted", _cells(F.col("value")).alias("cells")).where(F.get("cells", "stamp") != time_header)
    return rows.select(F.get("cells", "stamp").try_cast("timestamp_ntz").alias("ts"), "cells", "wanted")


def read_ts_pointers(
    spark: SparkSession, pointer_path: str, data_root: str, time_header: str = "DateTime", multi_line: bool = False
) -> DataFrame:
    """Series rows named by pointers: which file and column to attach, to what and how.

    Everything below `data_root` is one scan. A `data_file` is one CSV or a folder of parts. Pointers meet the
    headers of the files first, which gives each its place in a line; a line then takes out those places and no others.
    Pointers are one object per line or an array on one line; `multi_line` reads an array spread over lines.
    """
    pointers = spark.read.schema(POINTER_SCHEMA).json(pointer_path, multiLine=multi_line)
    lines = _pointed_lines(spark, data_root, pointers, time_header)
    taken = F.transform("wanted", lambda w: F.struct(w["component_name"].alias("component_name"), *(w[c].alias(c) for c in _KEPT), F.get("cells", w["place"]).alias("cell")))
    return lines.select("ts", F.inline(taken)).select("component_name", *_KEPT, "ts", F.col("cell").try_cast("double").alias("value"))


def attach_pointer_series(series: DataFrame, fields: DataFrame) -> DataFrame:
    """Pointer series with the stored rule carried out: `normalized` by the factor and `scaled` by the component's field.

    `fields(component_name, field, amount)` holds the components' values; the multiplier `get_<field>` names the one to
    multiply with. Without a multiplier, or without that field, `scaled` is the normalized value.
    """
    keys = ["component_name", "name", "simulation"]
    factors = series.select(*keys, F.col("normalization_factor").alias("factor")).distinct()
    normal = normalize_series(series.withColumns({k: F.coalesce(k, F.lit("")) for k in keys}), factors.withColumns({k: F.coalesce(k, F.lit("")) for k in keys}), keys).drop("factor")
    amounts = fields.select(F.col("component_name"), F.concat(F.lit("get_"), "field").alias("scaling_factor_multiplier"), "amount")
    return normal.join(amounts, ["component_name", "scaling_factor_multiplier"], "left").withColumn("scaled", F.col("normalized") * F.coalesce("amount", F.lit(1.0))).drop("amount")
