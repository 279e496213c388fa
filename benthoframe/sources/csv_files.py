"""Reading folders of survey CSV files.

Files of one folder may have different columns, and Spark reads many CSV files by position. So one pass finds the header of every
file, and a second reads all files by position, as text, and picks each dictionary column from where the header of the row's file
has it. Types come later, so that a bad value is a violation instead of a silent NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benthoframe.functions.columns import ensure_columns
from benthoframe.session import settle
from benthoframe.sources import dictionary as dd

# Never present in the data: keeps an empty cell (NULL) apart from the text NA.
_NO_NULL_TEXT = "\u0001"
MISSING = "NA"
# The line of a row that has more or fewer cells than the header of its file.
BROKEN_ROW = "_broken_row"
# Where the file of a row has each dictionary column, from 1; 0 where it lacks it.
PLACES = "_places"
# A comma outside quotes, and a cell in quotes.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
_QUOTED = r'^"(?:[^"]|"")*"$'


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """(path, File, columns) per file of a folder, read in one distributed pass.

    The header is the first line of the block that starts the file; row ids grow
    within a block, so it is the line with the smallest id.
    """
    lines = spark.read.text(folder).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("File"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    first = (
        lines.filter("start = 0")
        .groupBy("path", "File")
        .agg(F.min_by("value", "id").alias("header"))
    )
    line = F.regexp_replace("header", "^\ufeff|\r$", "")
    # commas inside quotes are part of a name
    cells = F.transform(F.split(line, _COMMA), lambda c: F.trim(c))
    bare = lambda c: F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    names = F.transform(cells, lambda c: F.when(c.rlike(_QUOTED), F.trim(bare(c))).otherwise(c))
    return first.select("path", "File", names.alias("columns"))


def count_cells(line: Column) -> Column:
    """Cells of the text of a CSV row."""
    bare = F.regexp_replace(line, r'(^|,)\s*"(?:[^"]|"")*"\s*(?=,|$)', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def empty_files(spark: SparkSession, folder: str) -> DataFrame:
    """(File) of every file of a folder without a byte; readers never see those, so the folder is listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    empty = [
        (file.getPath().getName(),)
        for status in fs.globStatus(path) or []
        for file in (fs.listStatus(status.getPath()) if status.isDirectory() else [status])
        if file.isFile() and file.getLen() == 0 and file.getPath().getName()[0] not in "._"
    ]
    return spark.createDataFrame(empty, "File string")


def read_cells(
    spark: SparkSession, folder: str, headers: DataFrame, table: str, multiline: bool = False
) -> DataFrame:
    """The rows of all files of a folder in one scan (S1): File, every dictionary column as text, `PLACES`, `BROKEN_ROW`.

    `headers` are those of `read_headers`, settled. A column that the row's file lacks is NULL and has place 0 in
    `PLACES`, which follows the dictionary; an empty cell is NULL, the text ``NA`` is kept until `type_columns`.
    `BROKEN_ROW` has the line of a row with more or fewer cells than the header of its file, and is NULL otherwise.
    """
    most = headers.agg(F.max(F.size("columns"))).first()[0]
    if most is None:
        raise FileNotFoundError(f"No CSV files in {folder}.")
    positions = [f"_c{i}" for i in range(most)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*positions, BROKEN_ROW]])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multiline)
        .option("columnNameOfCorruptRecord", BROKEN_ROW)
        .option("columnPruning", False)  # else only the wanted cells are counted
        .option("nullValue", _NO_NULL_TEXT)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(folder)
    )
    names = [a.name for a in dd.attributes(table)]
    places = F.array(*[F.array_position("columns", F.lit(n)).cast("int") for n in names])
    heads = headers.select(F.col("path").alias("_path"), F.size("columns").alias("_width"), places.alias(PLACES))
    rows = raw.select(
        F.col("_metadata.file_path").alias("_file_path"), F.col("_metadata.file_name").alias("File"),
        *positions, BROKEN_ROW,
    ).join(heads, F.col("_file_path") == F.col("_path"))
    cells = F.array(*positions)
    # the reader compares with the widest header: it gives the line of every other number of cells
    found = F.when(F.col(BROKEN_ROW).isNull(), most).otherwise(count_cells(F.col(BROKEN_ROW)))
    line = F.coalesce(BROKEN_ROW, F.array_join(cells, ",", ""))
    return rows.select(
        "File",
        *[F.get(cells, F.get(PLACES, F.lit(i)) - 1).alias(n) for i, n in enumerate(names)],
        PLACES,
        F.when(found != F.col("_width"), line).alias(BROKEN_ROW),
    )


def unite(parts: list[DataFrame]) -> DataFrame:
    """Unite tables by column name; a column a part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_typed_folder(
    spark: SparkSession, folder: str, table: str, multiline: bool = False
) -> DataFrame:
    """All CSV files of a folder in the types of the dictionary, unchecked."""
    headers = settle(read_headers(spark, folder), "headers")
    return type_columns(read_cells(spark, folder, headers, table, multiline), table)


def parse_value(text: Column, datatype: str) -> Column:
    """A dictionary value from its text; NULL when it does not fit the datatype."""
    if datatype == "Double":
        value = F.when(is_number(text), text.try_cast("double"))
        return F.nullif(value, F.lit(float("nan")))
    if datatype == "Integer":
        return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    if datatype == "Boolean":
        number = F.when(is_number(text), text.try_cast("double"))
        word = F.lower(text)
        return F.when((number == 1) | (word == "true"), True).when((number == 0) | (word == "false"), False)
    if datatype == "Date":
        return F.try_to_date(text, "d/M/yyyy")
    return text


def is_number(text: Column) -> Column:
    """Whether the text is a decimal number."""
    return text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")


def type_columns(raw: DataFrame, table: str) -> DataFrame:
    """Text columns to the types of the dictionary, adding missing ones as NULL (S3).

    Columns that the dictionary does not know are dropped; `validate` reports them.
    """
    present = set(raw.columns)
    typed = {
        a.name: parse_value(F.nullif(F.col(a.name), F.lit(MISSING)), a.datatype)
        for a in dd.attributes(table)
        if a.name in present
    }
    own = [F.col("File")] if "File" in present else []
    known = raw.select(*own, *[c.alias(n) for n, c in typed.items()])
    full = ensure_columns(known, dd.fields(table))
    return full.select(*own, *[a.name for a in dd.attributes(table)])
