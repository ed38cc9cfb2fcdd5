"""Raw text tables: loaded exactly as they are, nothing cleaned."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_options(multi_line: bool) -> dict:
    """Values may hold line breaks only with `multi_line`, which makes a file one task."""
    return {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}


# The columns of the raw files.
RAW_COLUMNS = {
    "raw_accounts": (
        "account_id", "company_name", "domain", "seed_industry", "hq_country", "is_real_domain", "source",
        "source_updated_at", "sim_hiring_data_roles", "sim_months_since_funding", "sim_tech_stack_match",
    ),
    "raw_contacts": (
        "contact_id", "account_id", "first_name", "last_name", "email", "title", "source_updated_at",
    ),
    "raw_engagement": ("event_id", "contact_id", "event_type", "event_ts"),
    "planted_errors": (
        "error_id", "error_type", "table_name", "record_id", "field", "original_value", "planted_value",
        "related_record_id",
    ),
}


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _files(spark: SparkSession, table: str, path: str, read) -> DataFrame:
    try:
        return read(spark.read)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"source of {table} not found: {path}") from e
        raise


def load_raw(spark: SparkSession, table: str, path: str, multi_line: bool = True, broken: str = "fail") -> DataFrame:
    """A raw table from CSV: every column text, whitespace and casing kept, plus `_loaded_at`.

    `path` may be a file or a folder of files with the same header. The header is checked
    against the expected columns. Without `multi_line` no value may hold a line break, and large
    files are split between tasks.

    Records with too many or too few fields lose nothing in silence. `broken` says what becomes of
    them: "fail" stops the load at the first one, "drop" leaves out what `raw_rejects` returns,
    and "pad" cuts or fills them to the table's width.
    """
    if broken == "drop":
        parsed = _parsed(spark, table, path, multi_line)
        _check_headers(parsed, table)
        df = parsed.filter("reason IS NULL AND NOT is_header").select("fields.*")
    else:
        mode = {"fail": "FAILFAST", "pad": "PERMISSIVE"}[broken]
        # a pruned column would not be counted
        options = {**csv_options(multi_line), "enforceSchema": False, "mode": mode, "columnPruning": broken == "pad"}
        schema = text_schema(RAW_COLUMNS[table])
        df = _files(spark, table, path, lambda reader: reader.schema(schema).options(**options).csv(path))
    return df.withColumn("_loaded_at", F.current_timestamp())


def _records(spark: SparkSession, table: str, path: str, multi_line: bool) -> DataFrame:
    """(source_file, line_text): the text of every record, headers too.

    Lines are records without `multi_line`. With it the CSV reader finds the records; read as one column, all
    others are malformed to it, and it hands out their text.
    """
    source = F.col("_metadata.file_path").alias("source_file")
    if not multi_line:
        return _files(spark, table, path, lambda reader: reader.text(path)).select(
            source, F.col("value").alias("line_text")
        )
    options = {**csv_options(True), "header": False, "columnNameOfCorruptRecord": "_text", "columnPruning": False}
    schema = text_schema(["_only", "_text"])
    df = _files(spark, table, path, lambda reader: reader.schema(schema).options(**options).csv(path))
    return df.select(source, F.coalesce("_text", "_only").alias("line_text"))


def _parsed(spark: SparkSession, table: str, path: str, multi_line: bool) -> DataFrame:
    """Records with their fields, whether they are a header, and why they are broken, if they are."""
    names = RAW_COLUMNS[table]
    records = _records(spark, table, path, multi_line).filter(F.trim("line_text") != "")
    options = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_text", "mode": "PERMISSIVE"}
    schema = ", ".join(f"{c} string" for c in (*names, "_text"))
    # quoted stretches out of the way, what is left are separators and quotes that nothing closes
    rest = F.regexp_replace("line_text", '"[^"]*+"', "")
    count = F.size(F.split("rest", ",", -1))
    misfit = F.col("parsed._text").isNotNull()
    return records.withColumns({"rest": rest, "parsed": F.from_csv("line_text", schema, options)}).select(
        "source_file", "line_text", count.alias("n_fields"),
        F.struct(*[F.col(f"parsed.{c}") for c in names]).alias("fields"),
        reduce(Column.__and__, [F.lower(F.col(f"parsed.{c}")).eqNullSafe(c) for c in names]).alias("is_header"),
        F.when(F.col("rest").rlike('(^|,)"'), "unclosed quote")
        .when(misfit & (count > len(names)), "extra fields")
        .when(misfit & (count < len(names)), "missing fields")
        .when(misfit, "unreadable").alias("reason"),
    )


def _check_headers(parsed: DataFrame, table: str) -> None:
    bare = parsed.groupBy("source_file").agg(F.max("is_header").alias("found")).filter("NOT found").head(5)
    if bare:
        raise ValueError(f"no header of {table} in {', '.join(r['source_file'] for r in bare)}")


def raw_rejects(spark: SparkSession, table: str, path: str, multi_line: bool = True) -> DataFrame:
    """(source_file, line_text, n_fields, reason) of every record that does not have the table's shape.

    The text is the record as it stands in the file. Reasons are `extra fields`, `missing fields`,
    `unclosed quote` (with `multi_line` such a record reaches to the end of its file) and
    `unreadable`. `load_raw(..., broken="drop")` has all other records, so the two together hold
    the whole source. Lines of white space alone are no records; a file without a header is an
    error.
    """
    parsed = _parsed(spark, table, path, multi_line)
    _check_headers(parsed, table)
    return parsed.filter("reason IS NOT NULL").select("source_file", "line_text", "n_fields", "reason")


def load_all_raw(
    spark: SparkSession, paths: dict[str, str], multi_line: bool | Mapping[str, bool] = True, broken: str = "fail"
) -> dict[str, DataFrame]:
    """Every raw table; fails on the first one whose source is missing.

    `multi_line` may say for each table whether its values can hold line breaks; tables it does
    not name can. A table of single lines is split between tasks.
    """
    def lines(table: str) -> bool:
        return multi_line if isinstance(multi_line, bool) else multi_line.get(table, True)

    return {table: load_raw(spark, table, path, lines(table), broken) for table, path in paths.items()}
