"""Reading delivered files: types from inference and hints, rescued values, delivery columns."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from duebook.session import path_exists
from duebook.sources.headers import cells_by_header, column_places, csv_lines, first_lines

RESCUED = "_rescued_data"
WHOLE_LINE = "_line"


def hinted_schema(
    spark: SparkSession,
    path: str,
    hints: str,
    form: str = "csv",
    keep_at: str | None = None,
    sampling: float = 1.0,
) -> StructType:
    """Infer the column types of the files at ``path`` and replace those that are hinted.

    ``keep_at`` names a folder for the schema: it is written on first use and read afterwards,
    so later files never change it. JSON columns that are hinted but not seen yet are added.
    """
    if keep_at and path_exists(spark, keep_at):
        kept = spark.read.schema("doc STRING").json(keep_at).first()
        return StructType.fromJson(json.loads(kept.doc))
    reader = spark.read.option("samplingRatio", sampling).option("recursiveFileLookup", True)
    if form == "csv":
        inferred = reader.option("header", True).option("inferSchema", True).csv(path).schema
    else:
        inferred = reader.json(path).schema
    hinted = {field.name.lower(): field for field in StructType.fromDDL(hints)}
    fields = [
        StructField(f.name, hinted.pop(f.name.lower(), f).dataType) for f in inferred.fields
    ]
    if form != "csv":
        fields += [StructField(f.name, f.dataType) for f in hinted.values()]
    schema = StructType(fields)
    if keep_at:
        spark.createDataFrame([(schema.json(),)], "doc STRING").coalesce(1).write.json(keep_at)
    return schema


def as_text(schema: StructType) -> StructType:
    """The same columns, all text, plus one for lines that do not have these columns."""
    fields = [StructField(f.name, StringType()) for f in schema.fields]
    return StructType([*fields, StructField(WHOLE_LINE, StringType())])


def with_delivery_columns(df: DataFrame) -> DataFrame:
    """Add load time and source file to rows read from files, batch or stream. Grain: unchanged."""
    return df.withColumns(
        {"_ingested_at": F.current_timestamp(), "_source_file": F.col("_metadata.file_path")}
    )


def fit_types(raw: Sequence[tuple[StructField, Column]], spare: Column) -> list[Column]:
    """Typed columns and the rescue column for raw text values.

    A value that does not fit its type becomes null and goes to ``_rescued_data``, a JSON object
    of column name and raw text; null there means that everything fit. ``spare`` is a map of
    further unexpected values.
    """
    typed, names, misfits = [], [], []
    for field, text in raw:
        value = text.try_cast(field.dataType) if field.dataType != StringType() else text
        typed.append(value.alias(field.name))
        names.append(F.lit(field.name))
        misfits.append(F.when(text.isNotNull() & value.isNull(), text))
    misfit = F.map_filter(
        F.map_from_arrays(F.array(*names), F.array(*misfits)), lambda _, v: v.isNotNull()
    )
    all_of = F.map_concat(misfit, spare)
    return [*typed, F.when(F.size(all_of) > 0, F.to_json(all_of)).alias(RESCUED)]


def csv_rows(df: DataFrame, schema: StructType) -> DataFrame:
    """Type rows read with ``as_text(schema)``; keeps delivery columns. Grain: unchanged."""
    line = F.when(
        F.col(WHOLE_LINE).isNotNull(), F.create_map(F.lit(WHOLE_LINE), F.col(WHOLE_LINE))
    ).otherwise(F.create_map().cast("map<string,string>"))
    columns = fit_types([(f, F.col(f.name)) for f in schema.fields], line)
    extra = [c for c in ("_ingested_at", "_source_file") if c in df.columns]
    return df.select(*columns, *extra)


def json_rows(df: DataFrame, schema: StructType) -> DataFrame:
    """Type JSON lines in the text column ``value``; keeps delivery columns. Grain: unchanged.

    Unknown fields and lines that are no JSON object are rescued.
    """
    fields = F.from_json("value", "map<string,string>")
    named = df.withColumn("_fields", fields)
    known = [F.lit(f.name) for f in schema.fields]
    unknown = F.map_filter(
        "_fields", lambda name, value: ~name.isin(*known) & value.isNotNull()
    )
    spare = F.when(F.col("_fields").isNotNull(), unknown).otherwise(
        F.create_map(F.lit(WHOLE_LINE), F.col("value"))
    )
    raw = [(f, F.try_element_at("_fields", F.lit(f.name))) for f in schema.fields]
    extra = [c for c in ("_ingested_at", "_source_file") if c in df.columns]
    return named.select(*fit_types(raw, spare), *extra)


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, strict: bool = False
) -> DataFrame:
    """Batch read of CSV files with a header, typed and with rescue and delivery columns.

    Every file is read by its own header: columns may be reordered, a missing one is null, and
    values of an unexpected one go to the rescue column. ``strict``: another header stops the read.
    """
    if strict:
        return csv_rows(with_delivery_columns(_csv(spark.read, schema).csv(path)), schema)
    lines = csv_lines(spark.read, path)
    return rows_by_header(lines, first_lines(lines), schema)


def rows_by_header(lines: DataFrame, headers: DataFrame, schema: StructType) -> DataFrame:
    """Type the lines of CSV files whose ``headers`` are known. Grain: one row per data line."""
    places = column_places(headers, schema)
    rows, raw, spare = cells_by_header(lines, places, schema, WHOLE_LINE)
    columns = fit_types([*zip(schema.fields, raw, strict=True)], spare)
    return rows.select(
        *columns, F.current_timestamp().alias("_ingested_at"), F.col("_path").alias("_source_file")
    )


def read_json(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Batch read of JSON lines, typed and with rescue and delivery columns."""
    return json_rows(with_delivery_columns(_deep(spark.read).text(path)), schema)


def stream_csv(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    files_per_batch: int | None = None,
    headers: DataFrame | None = None,
) -> DataFrame:
    """The same as a stream over a folder: every file is read once.

    ``headers`` holds the first line of each file (see ``ingest_csv``); without it all files must
    have the columns of ``schema`` in order.
    """
    if headers is not None:
        lines = csv_lines(_paced(spark.readStream, files_per_batch), folder)
        return rows_by_header(lines, headers, schema)
    reader = _csv(_paced(spark.readStream, files_per_batch), schema)
    return csv_rows(with_delivery_columns(reader.csv(folder)), schema)


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the text files of a folder as a stream, with the file they are from."""
    return csv_lines(spark.readStream, folder)


def stream_json(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """JSON lines as a stream over a folder."""
    reader = _deep(_paced(spark.readStream, files_per_batch))
    return json_rows(with_delivery_columns(reader.text(folder)), schema)


def _paced(reader, files_per_batch: int | None):
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def _deep(reader):
    return reader.option("recursiveFileLookup", True)


def _csv(reader, schema: StructType):
    return (
        _deep(reader)
        .schema(as_text(schema))
        .option("header", True)
        .option("columnNameOfCorruptRecord", WHOLE_LINE)
        # A header that differs from the schema stops the read instead of shifting columns.
        .option("enforceSchema", False)
    )


def landing_problems(
    spark: SparkSession,
    path: str,
    required: Sequence[str],
    expected: Sequence[str] = (),
    name: Column | None = None,
) -> DataFrame:
    """Check landed CSV files before they are ingested.

    Grain: one row per delivery found or expected: ``file``, ``missing_columns`` of its headers,
    ``data_rows``, ``problem`` (null when it is fine). Headers are the first line of the first
    block of a file. A delivery is one
    file, or all files that ``name``, an expression over ``path`` and ``file``, calls the same.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    # Numbers are added up by hash; no line is sorted, and only first lines are moved.
    counts = lines.groupBy("_path", "file").agg(
        (F.count_if(F.trim("value") != "") - 1).alias("data_rows")
    )
    files = counts.join(first_lines(lines), "_path").withColumnRenamed("_path", "path")
    header = F.transform(
        F.split("_header", ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', "")
    )
    wanted = F.array(*(F.lit(c) for c in required))
    found = (
        files.withColumn("_missing", F.array_except(wanted, header))
        .groupBy((F.col("file") if name is None else name).alias("file"))
        .agg(
            # At most as many different lists as there are subsets of the required columns.
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("_missing")))).alias(
                "missing_columns"
            ),
            F.sum("data_rows").alias("data_rows"),
        )
    )
    if expected:
        names = spark.createDataFrame([(name,) for name in expected], "file STRING")
        found = found.join(names, "file", "full")
    problem = (
        F.when(F.col("data_rows").isNull(), "not landed")
        .when(F.size("missing_columns") > 0, "columns missing")
        .when(F.col("data_rows") < 1, "no data rows")
    )
    return found.withColumn("problem", problem)
