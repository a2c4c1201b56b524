"""Bronze source: CSV records under a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quoted fields may hold line breaks; a doubled quote is a literal quote.
CSV_OPTIONS = {"quote": '"', "escape": '"', "encoding": "UTF-8", "header": "true"}

# Where asked for, the text of a record whose fields, or their number, are not as declared.
RECORD = "_record"


class RecordsCrossLines(ValueError):
    """Input declared to have one record a line has a record that goes on in the next."""


def read_records(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    strict_header: bool = False,
    multi_line: bool = True,
    with_record: bool = False,
) -> DataFrame:
    """All files of a folder as one table; the header record of each is skipped.

    Columns bind by position. Fields that do not parse become NULL and keep their row.
    ``strict_header`` refuses files whose header names differ instead of binding them by
    position.

    With ``multi_line`` fields may hold line breaks, and a file is one task, whatever its
    size: deliver many files. Without it the caller declares one record a line, and files
    are split into blocks. That is checked, at the cost of reading the lines once more.

    ``with_record`` adds a column with the text of each record that is not as declared. All
    columns are parsed then, whatever is used of them.
    """
    if not multi_line:
        require_single_lines(spark, path)
    reader = spark.read.options(
        **CSV_OPTIONS, enforceSchema=not strict_header, multiLine=multi_line
    )
    if with_record:
        schema = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
        reader = reader.options(columnNameOfCorruptRecord=RECORD, columnPruning=False)
    return reader.schema(schema).csv(path)


# A line of whole fields, once doubled quotes are taken out. A quoted field needs its closing
# quote; what stands behind that up to the comma, and a quote inside a plain field, end with it.
_FIELD = r'(?:"[^"]*+"[^,]*+|[^",][^,]*+|)'
_WHOLE_FIELDS = f"^{_FIELD}(?:,{_FIELD})*+$"


def require_single_lines(spark: SparkSession, path: str | list[str]) -> None:
    """Raises if a line ends inside a quoted field: its record goes on in the next line."""
    plain = F.replace("value", F.lit('""'), F.lit(""))
    crossing = spark.read.text(path).filter(
        F.contains("value", F.lit('"')) & ~plain.rlike(_WHOLE_FIELDS)
    )
    if not crossing.isEmpty():
        raise RecordsCrossLines(f"records in {path} cross lines: read them with multi_line")
