"""Scans: tolerant JSON lines, array files, mixed directories, tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill import fixed
from talkmill.session import stage

CORRUPT = "_corrupt"


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def closes_early(line: Column) -> Column:
    """The line, put in brackets, could end the brackets before its own end:
    it has a closing bracket and does not fit inside an object."""
    inside = F.json_array_length(F.concat(F.lit('[{"v":'), line, F.lit("}]"))) == 1
    return F.contains(line, F.lit("]")) & ~F.coalesce(inside, F.lit(False))


def is_json(line: Column) -> Column:
    """The line is one whole JSON value: nothing behind it, no single quotes.

    Readers accept text behind a complete value, so the line is read inside
    brackets, where such text is an error.  One rule holds at every length.
    """
    bracketed = F.concat(F.lit("["), line, F.lit("]"))
    strict = F.size(F.from_json(bracketed, "array<string>", {"allowSingleQuotes": "false"})) == 1
    one = F.json_array_length(bracketed) == 1
    return F.coalesce(one & ~closes_early(line) & strict, F.lit(False))


def json_lines(spark: SparkSession, path: str, schema: str | T.StructType, keep_bad: bool = False) -> DataFrame:
    """JSON lines; malformed lines (also values that are no objects) are
    skipped, or kept with their text in ``_corrupt`` when ``keep_bad``."""
    wide = _schema(schema).add(CORRUPT, "string")
    options = {"columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"}
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    bad = F.col(f"_r.{CORRUPT}").isNotNull() | ~is_json(F.col("value")) | ~F.col("value").rlike(r"^\s*\{")
    rows = lines.select("value", F.from_json("value", wide, options).alias("_r")).select(
        *[F.col(f"_r.{f.name}").alias(f.name) for f in _schema(schema).fields],
        F.when(bad, F.col("value")).alias(CORRUPT),
    )
    return rows if keep_bad else rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def line_report(spark: SparkSession, path: str) -> DataFrame:
    """One row ``valid, malformed`` of a JSON-lines corpus."""
    good = is_json(F.col("value"))
    return spark.read.option("recursiveFileLookup", True).text(path).agg(
        F.count_if(good).alias("valid"), F.count_if(~good).alias("malformed")
    )


def json_arrays(spark: SparkSession, path: str, schema: str | T.StructType, glob: str = "*.json") -> DataFrame:
    """Files that hold one JSON array each.  A file is read by one task; many
    files are read side by side.  For large files see ``split_json_arrays``."""
    return (
        spark.read.schema(_schema(schema))
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .json(path)
    )


def _closing_pieces(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """The files cut at closing braces, each task reading blocks of its own:
    ``_file, _block, _row, value`` and what a piece does to quotes and depth.

    ``_quotes``: its unescaped quotes; ``_out`` and ``_in``: how much deeper
    its brackets lead, the closing brace not counted, if it begins outside or
    inside a string.  An escape never spans two pieces.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", "}")
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    string = r'"[^"]*("|\z)'
    outside = F.regexp_replace(plain, string, "")
    inside = F.regexp_replace(F.regexp_replace(plain, r'\A[^"]*("|\z)', ""), string, "")

    def deeper(text: Column) -> Column:
        return F.regexp_count(text, F.lit(r"[\[{]")) - F.regexp_count(text, F.lit(r"[\]}]"))

    return reader.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
        F.regexp_count(plain, F.lit('"')).alias("_quotes"),
        deeper(outside).alias("_out"),
        deeper(inside).alias("_in"),
    )


def split_json_arrays(spark: SparkSession, path: str, schema: str | T.StructType, glob: str = "*.json") -> DataFrame:
    """The objects of files that hold one JSON array (or one object) each; a
    large file is read by many tasks.

    Whether a block of a file begins inside a string, and how deep, follows
    from the blocks before it: each block says what it does to either state,
    and these are composed in file order, one row per block.  An object ends
    at a brace outside strings that leads back to the array's depth.  Pieces
    of an object meet by file and number, so memory holds one object, however
    large its file.  Objects that do not fit the schema are skipped, as are
    elements that are no objects; an empty array or file gives no rows.
    """
    pieces = stage(_closing_pieces(spark, path, glob), "pieces")
    place = ["_file", "_block"]
    upto = Window.partitionBy(*place).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*place).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    parity = F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2
    odd = (F.sum("_quotes").over(upto) % 2).alias("_odd")
    marked = pieces.select(*place, "_row", "value", parity.alias("_parity"), odd, "_out", "_in")
    # The closing brace of a piece counts where it stands outside a string.
    def steps(starts_inside: int) -> Column:
        begins, ends = F.col("_parity") != starts_inside, F.col("_odd") != starts_inside
        return F.when(begins, F.col("_in")).otherwise(F.col("_out")) - F.when(ends, 0).otherwise(1)

    marked = marked.withColumns({"_a": F.sum(steps(0)).over(upto), "_b": F.sum(steps(1)).over(upto)}).select(*place, "_row", "value", "_odd", "_a", "_b")
    marked = stage(marked, "pieces")

    ends = marked.groupBy(*place).agg(
        F.max_by(F.struct("_odd", "_a", "_b"), "_row").alias("e"), F.min_by(F.col("value").rlike(r"\A[\s\uFEFF]*\["), "_row").alias("array")
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(*place, "e", "array", (F.coalesce(F.sum("e._odd").over(earlier), F.lit(0)) % 2).alias("_inside"))
    depth = F.sum(F.when(F.col("_inside") == 1, F.col("e._b")).otherwise(F.col("e._a"))).over(earlier)
    first = F.first("array").over(earlier.rowsBetween(Window.unboundedPreceding, 0))
    starts = starts.select(*place, "_inside", F.coalesce(depth, F.lit(0)).alias("_depth"), F.when(first, 1).otherwise(0).alias("_base"))

    known = marked.join(starts, place)
    reached = F.col("_depth") + F.when(F.col("_inside") == 1, F.col("_b")).otherwise(F.col("_a"))
    closes = (F.col("_odd") == F.col("_inside")) & (reached == F.col("_base"))
    known = known.withColumn("_closes", closes.cast("int"))
    counts = known.groupBy(*place).agg(F.sum("_closes").alias("n"))
    offsets = counts.select(*place, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_offset"))
    number = F.coalesce(F.sum("_closes").over(before), F.lit(0))
    numbered = known.select(*place, "_row", "value", "_base", number.alias("_number")).join(offsets, place)
    objects = numbered.groupBy("_file", (F.col("_number") + F.col("_offset")).alias("_n")).agg(
        F.max("_base").alias("_base"), F.array_sort(F.collect_list(F.struct("_block", "_row", "value"))).alias("p")
    )
    whole = F.concat(F.array_join("p.value", "}"), F.lit("}"))
    opened = (F.col("_n") == 0) & (F.col("_base") == 1)
    whole = F.when(opened, F.regexp_replace(whole, r"\A[\s\uFEFF]*\[", "")).otherwise(whole)
    text = F.regexp_replace(whole, r"\A[\s\uFEFF,]+", "")
    # Other elements before an object: the stretch is an array's inside.
    several = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    texts = F.when(F.startswith(text, F.lit("{")), F.array(text)).otherwise(several)
    found = objects.select(F.explode(texts).alias("t")).filter(F.startswith("t", F.lit("{")))
    wide = _schema(schema).add(CORRUPT, "string")
    options = {"columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"}
    read = found.select(F.from_json("t", wide, options).alias("r")).filter(F.col(f"r.{CORRUPT}").isNull())
    return read.select(*[F.col(f"r.{f.name}").alias(f.name) for f in _schema(schema).fields])


def json_array_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Lines that hold one JSON array each, one row per element."""
    element = T.ArrayType(_schema(schema))
    lines = spark.read.option("recursiveFileLookup", True).text(path).filter(is_json(F.col("value")))
    return lines.select(F.inline(F.from_json("value", element)))


def mixed_directory(
    spark: SparkSession,
    path: str,
    array_schema: str | T.StructType,
    line_schema: str | T.StructType | None = None,
    array_glob: str = "*.json",
    line_glob: str = "*.jsonl",
) -> DataFrame:
    """All ``.json`` (array) and ``.jsonl`` (lines) files below a directory, or
    those of two other patterns, as one dataset with ``file_name``; columns of
    one kind only are NULL for the other."""
    name = F.col("_metadata.file_name").alias("file_name")
    arrays = json_arrays(spark, path, array_schema, array_glob).select("*", name)
    wide = _schema(line_schema or array_schema)
    text = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", line_glob).text(path)
    )
    good = text.select("value", name).filter(is_json(F.col("value")) & F.col("value").rlike(r"^\s*\{"))
    lines = good.select(F.from_json("value", wide).alias("_r"), "file_name").select(
        *[F.col(f"_r.{f.name}").alias(f.name) for f in wide.fields], "file_name"
    )
    return arrays.unionByName(lines, allowMissingColumns=True)


def collection(spark: SparkSession, path: str, *where, columns: tuple[str, ...] = ("*",), fmt: str = "parquet") -> DataFrame:
    """Stored rows that meet all tests, with the wanted columns only."""
    rows = spark.read.format(fmt).load(path)
    for test in where:
        rows = rows.filter(test)
    return rows.select(*columns)


def warehouse(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """A SQL query; ``{name}`` in it stands for the frame passed as ``name``."""
    return spark.sql(query, **tables)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of several files, tables or rounds; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def template_tables(template: str) -> list[str]:
    """Tables a chat template trains on."""
    return fixed.TEMPLATE_TABLES.get(template, fixed.OTHER_TEMPLATE_TABLES)


def read_for_template(tables: dict[str, DataFrame], template: str, version: str | None = None) -> DataFrame:
    """Rows of the template's tables, of one version when given."""
    rows = union_all([tables[name] for name in template_tables(template)])
    return rows if version is None else rows.filter(F.col("version") == version)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
