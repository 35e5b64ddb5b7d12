"""Raw line-item feed in CSV form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import schemas

# Cell texts read as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

#: The whole line, where its number of cells is not that of the schema.
_ODD_LINE = "_odd_line"


def read_raw_csv(
    spark: SparkSession,
    path: str,
    *,
    encoding: str = "ISO-8859-1",
    timestamp_format: str = TIMESTAMP_FORMAT,
    multi_line: bool = False,
) -> DataFrame:
    """The eight raw columns, matched by position whatever the header calls them.

    No schema inference, so the files are read once. Cells are read as text first: missing
    markers become NULL, anything else that does not parse fails the job with the cell's
    text, in ANSI mode or not. A whole number may be written with zero decimals (``4.0``).

    A line with more cells than columns fails the job with its text; one with fewer has
    NULL in the missing columns (so a line cut off before its customer id counts as
    anonymous). These checks look at every line, whatever columns are read later.

    Set ``multi_line`` for feeds with line breaks inside quotes; such files cannot be split
    between tasks. Without it, half a quoted cell fails the job.
    """
    texts = (
        spark.read.schema(", ".join(f"{n} string" for n in [*schemas.RAW.names, _ODD_LINE]))
        .option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", _ODD_LINE)
        # Cells can only be counted if the reader cuts all of them.
        .option("columnPruning", False)
        .csv(path)
    )
    return texts.filter(_is_whole(F.col(_ODD_LINE))).select(
        *[
            _parsed(field.name, field.dataType.simpleString(), timestamp_format)
            for field in schemas.RAW
        ]
    )


def _is_whole(line: Column) -> Column:
    """True, or an error for a line with surplus cells or half a quoted cell."""
    unquoted = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    cells = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","))) + 1
    surplus = F.raise_error(
        F.concat(F.lit(f"line with more than {len(schemas.RAW)} cells: "), line)
    )
    half = F.raise_error(
        F.concat(F.lit("line break inside quotes (read with multi_line): "), line)
    )
    return (
        F.when(unquoted.contains('"'), half.cast("boolean"))
        .when(cells > len(schemas.RAW), surplus.cast("boolean"))
        .otherwise(F.lit(True))
    )


def _parsed(name: str, data_type: str, timestamp_format: str) -> Column:
    text = F.when(~F.col(name).isin(MISSING_TEXTS), F.col(name))
    if data_type == "string":
        return text.alias(name)
    if data_type == "timestamp_ntz":
        value = F.try_to_timestamp(text, F.lit(timestamp_format)).cast(data_type)
    elif data_type == "bigint":
        value = F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast(data_type)
    else:
        value = text.try_cast(data_type)
    bad = F.raise_error(F.concat(F.lit(f"{name} does not parse: "), text)).cast(data_type)
    return F.when(text.isNotNull() & value.isNull(), bad).otherwise(value).alias(name)
