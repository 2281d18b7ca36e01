"""CSV ingest with declared schemas and rejected-row handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestar.schemas import RAW, TEXT_WIDTH, text_columns

_BAD_LINE = "_bad_line"
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def read_raw(
    spark: SparkSession,
    path: str,
    table: str,
    mode: str = "PERMISSIVE",
    sep: str = ",",
    quote: str = '"',
    collation: str | None = None,
) -> DataFrame:
    """A feed file as a DataFrame; the header line is skipped, columns go by position.

    ``PERMISSIVE`` keeps every line and adds the text of those that do not fit
    the schema, for ``accepted`` and ``rejected``; ``FAILFAST`` stops on a line
    that ``rejected`` would list and ``DROPMALFORMED`` leaves them out. All modes
    share one verdict, whichever columns a query uses. ``quote=""`` reads
    quotes as ordinary characters. ``collation`` gives the text columns a
    collation, for sources whose codes and keys compare without case.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, not {mode!r}")
    schema = T.StructType([*RAW[table].fields, T.StructField(_BAD_LINE, T.StringType())])
    reader = spark.read.schema(schema).options(
        header=True, sep=sep, quote=quote, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD_LINE,
    )
    df = reader.csv(path)
    if collation:
        df = df.withColumns({name: F.collate(name, collation) for name in text_columns(table)})
    if mode == "FAILFAST":
        fits = F.when(_reason(table).isNull(), True)
        df = df.where(fits.otherwise(F.raise_error(F.concat(F.lit(f"line does not fit {table}: "), _line(table))).cast("boolean")))
    return df if mode == "PERMISSIVE" else accepted(df, table)


def _reason(table: str) -> Column:
    """Why a line is rejected, or NULL.

    Spark converts only the fields a query uses and finds a line malformed only
    by those. ``all_read`` is always true; it uses every field, so that the
    verdict never depends on the query.
    """
    too_long = " OR ".join(f"length({name}) > {TEXT_WIDTH}" for name in text_columns(table))
    all_read = f"size(array({', '.join(f'{name} IS NULL' for name in RAW[table].names)})) > 0"
    return F.expr(f"CASE WHEN {_BAD_LINE} IS NOT NULL AND {all_read} THEN 'malformed' WHEN {too_long} THEN 'over_long' END")


def _line(table: str) -> Column:
    return F.coalesce(F.col(_BAD_LINE), F.to_csv(F.struct(*RAW[table].names)))


def judged(lines: DataFrame, table: str) -> DataFrame:
    """Every line once: its columns, and for a line that does not fit its reason and text."""
    marked = lines.withColumn("reason", _reason(table))
    return marked.withColumn("line", F.when(F.col("reason").isNotNull(), _line(table))).drop(_BAD_LINE)


def accepted(lines: DataFrame, table: str) -> DataFrame:
    """The lines that fit the table: typed, complete, no text over its width."""
    return lines.where(_reason(table).isNull()).select(*RAW[table].names)


def rejected(lines: DataFrame, table: str) -> DataFrame:
    """The other lines, with the reason and their text."""
    return judged(lines, table).where("reason IS NOT NULL").select(F.lit(table).alias("table_name"), "reason", "line")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a feed as they are, but for the header of each file."""
    # A control character parts the fields, so a line is one; where it occurs the reader keeps the line apart.
    whole = spark.read.schema(f"line string, {_BAD_LINE} string").options(
        header=True, sep="\u0001", quote="", escape="", columnNameOfCorruptRecord=_BAD_LINE,
    )
    return whole.csv(path).select(F.coalesce(_BAD_LINE, "line").alias("line"))


def rejected_lines(lines: DataFrame, table: str, sep: str = ",", quote: str = '"') -> DataFrame:
    """Of raw ``lines`` those that do not fit: table_name, reason, faults, line.

    The verdict is that of ``read_raw``, as both parse alike. ``faults`` names the
    columns at fault: a field that is there and does not convert to its type, a
    text over its width; and ``number of fields`` for a line of too few or too many.
    """
    fields = RAW[table].fields
    options = {"sep": sep, "quote": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD_LINE}
    bad = f"{_BAD_LINE} STRING"
    typed = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields] + [bad])
    texts = ", ".join([f"{f.name} STRING" for f in fields] + [bad])
    parsed = lines.select("line", F.from_csv("line", typed, options).alias("typed"), F.from_csv("line", texts, options).alias("texts"))
    wrong = {f.name: f"texts.{f.name} IS NOT NULL AND typed.{f.name} IS NULL" for f in fields}
    wrong |= {name: f"length(texts.{name}) > {TEXT_WIDTH}" for name in text_columns(table)}
    named = [f"if({rule}, '{name}', NULL)" for name, rule in wrong.items()]
    count = f"if(texts.{_BAD_LINE} IS NOT NULL, 'number of fields', NULL)"
    too_long = " OR ".join(wrong[name] for name in text_columns(table))
    reason = f"CASE WHEN typed.{_BAD_LINE} IS NOT NULL THEN 'malformed' WHEN {too_long} THEN 'over_long' END"
    judged_ = parsed.selectExpr(f"'{table}' AS table_name", f"{reason} AS reason", f"concat_ws(', ', {', '.join([count, *named])}) AS faults", "line")
    return judged_.where("reason IS NOT NULL")


def write_csv(df: DataFrame, path: str) -> None:
    """A feed as CSV files with a header; padding is kept, NULL and '' become empty fields."""
    df.write.options(
        header=True, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
