"""CSV files whose headers differ: every file is read by the names of its own header.

A header is one short row per file. It says where each wanted column stands, which further columns
the file has, and how many cells a line of it should hold. Lines are cut by Spark's CSV parser, one branch
per number of cells and not per header, so reordered headers cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duebook.session import broadcast_if_small

# Header rows up to this number are broadcast; beyond, lines and headers meet in a shuffle.
FEW_FILES = 100_000
_OUTSIDE_QUOTES = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'
_NOT_READ = "a file landed after the headers were read: "


def csv_lines(reader, path: str | list[str]) -> DataFrame:
    """Lines of text files, batch or stream, with the file they are from."""
    lines = reader.option("recursiveFileLookup", True).text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def first_lines(lines: DataFrame) -> DataFrame:
    """The first line of each file. Grain: one row per file with a line: ``_path``, ``_header``.

    Only a number per file is added up over the lines; the lines themselves are not sorted.
    """
    placed = lines.where("_block = 0").withColumn("_at", F.monotonically_increasing_id())
    first = placed.groupBy("_path").agg(F.min("_at").alias("_at"))
    found = placed.join(broadcast_if_small(first, FEW_FILES), ["_path", "_at"])
    return found.select("_path", F.col("value").alias("_header"))


def column_places(headers: DataFrame, schema: StructType) -> DataFrame:
    """Where the columns of ``schema`` stand in each file. Grain: one row per file.

    ``_spots``: for each column of ``schema`` its place from 0, or -1 where the file lacks it.
    ``_surplus``: name and place of all other columns. ``_width``: cells of a line. Names compare
    without case; of a name that comes twice, the first place counts and the others are surplus.
    """
    text = F.regexp_replace("_header", "^﻿", "")
    names = F.transform(
        F.split(text, _OUTSIDE_QUOTES), lambda c: F.regexp_replace(F.trim(c), '^"|"$', "")
    )
    lowered = F.transform("_names", F.lower)
    spots = F.array(*(F.array_position(lowered, f.name.lower()).cast("int") - 1 for f in schema.fields))
    cells = F.transform("_names", lambda name, at: F.struct(name.alias("name"), at.alias("at")))
    surplus = F.filter(cells, lambda cell: ~F.array_contains(F.col("_spots"), cell["at"]))
    # A name stands once in a rescue object: repeated ones are told apart by their place.
    unique = F.transform(
        surplus,
        lambda cell: F.struct(
            F.when(F.array_position("_names", cell["name"]) == cell["at"] + 1, cell["name"])
            .otherwise(F.concat(cell["name"], F.lit("#"), cell["at"] + 1))
            .alias("name"),
            cell["at"].alias("at"),
        ),
    )
    return (
        headers.withColumn("_names", names)
        .withColumn("_spots", spots)
        .select("_path", "_header", "_spots", unique.alias("_surplus"), F.size("_names").alias("_width"))
    )


def cells_by_header(
    lines: DataFrame, places: DataFrame, schema: StructType, whole_line: str
) -> tuple[DataFrame, list[Column], Column]:
    """Cut ``lines`` into cells. Returns the rows, the raw text of each column of ``schema``, and a map
    of what is left: surplus columns with a value, and the line itself where its cells do not fit
    its header. Grain: one row per line that is neither empty nor a header.

    A line of a file that ``places`` does not know stops the query.
    """
    widths = [row[0] for row in places.select("_width").distinct().orderBy("_width").collect()]
    known = lines.join(broadcast_if_small(places, FEW_FILES), "_path", "left")
    rows = known.where(~((F.col("_block") == 0) & (F.col("value") == F.ifnull("_header", F.lit("")))) & (F.trim("value") != ""))
    cut = F.raise_error(F.concat(F.lit(_NOT_READ), "_path")).cast("struct<cells:array<string>,line:string>")
    for width in widths:
        fields = ", ".join(f"c{i} STRING" for i in range(width))
        parsed = F.from_csv(
            "value", f"{fields}, line STRING", {"columnNameOfCorruptRecord": "line"}
        )
        one = F.struct(
            F.array(*(parsed[f"c{i}"] for i in range(width))).alias("cells"),
            parsed["line"].alias("line"),
        )
        cut = F.when(F.col("_width") == width, one).otherwise(cut)
    rows = rows.withColumn("_cut", cut)
    raw = [F.get("_cut.cells", F.get("_spots", F.lit(i))) for i in range(len(schema.fields))]
    values = F.transform(
        "_surplus", lambda cell: F.struct(cell["name"], F.get("_cut.cells", cell["at"]).alias("value"))
    )
    surplus = F.map_from_entries(F.filter(values, lambda cell: cell["value"].isNotNull()))
    line = F.when(
        F.col("_cut.line").isNotNull(), F.create_map(F.lit(whole_line), F.col("_cut.line"))
    ).otherwise(F.create_map().cast("map<string,string>"))
    return rows, raw, F.map_concat(surplus, line)


def header_came_late(failure: Exception) -> bool:
    """Did a stream stop only because a file landed after the headers had been read?"""
    return _NOT_READ in str(failure)
