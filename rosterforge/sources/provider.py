"""Provider enrichment exports: a folder of CSV files whose headers may differ."""

from __future__ import annotations

import re
import warnings
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.operators.enrichment import FIELDS
from rosterforge.sources.raw import csv_options, text_schema

# Words a provider file uses for a missing value.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
DATE_COLUMN = "Enriched At"
PROBE_BYTES = 16_384       # read of a file to find its header line
PROBE_THREADS = 16         # files probed at once


def _export_name(path: Column) -> Column:
    """The export a row came from: the first path part ending in .csv, be it a file or a folder of parts."""
    return F.url_decode(F.regexp_extract(path, r"/([^/]+\.csv)(/|\z)", 1))


def provider_of(source_file: Column, cfg: Config) -> Column:
    out = F.lit(cfg.default_provider)
    for prefix, provider in cfg.provider_prefixes.items():
        out = F.when(source_file.startswith(prefix), provider).otherwise(out)
    return out


def _first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file, read in steps of PROBE_BYTES until it ends."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        head = b""
        while True:
            more = bytes(stream.readNBytes(PROBE_BYTES))
            head += more
            line = re.match(rb"[^\r\n]*(?=[\r\n])", head)
            if line or len(more) < PROBE_BYTES:
                return (line[0] if line else head).decode("utf-8", "replace")
    finally:
        stream.close()


def _headers(spark: SparkSession, pattern: list[str]) -> dict[str, list[str]]:
    """Files per header line. One line per file reaches the driver, which lists the files anyway.

    Spark lists the files without opening them; of each, only the first bytes are then read.
    """
    try:
        files = spark.read.format("binaryFile").load(pattern).filter("length > 0").select("path")
        paths = sorted(row["path"] for row in files.toLocalIterator())
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    grouped = defaultdict(list)
    with ThreadPoolExecutor(PROBE_THREADS) as pool:
        for path, header in zip(paths, pool.map(lambda path: _first_line(spark, path), paths)):
            grouped[header].append(path)
    return dict(grouped)


def _columns(spark: SparkSession, header: str) -> list[str]:
    header = header.removeprefix("\ufeff")
    fields = spark.createDataFrame([(header,)], "h string").select(
        F.from_csv("h", ", ".join(f"c{i} string" for i in range(header.count(",") + 1)), {"escape": '"'}).alias("f")
    ).first()["f"]
    return [name for name in fields if name is not None]


def missing_columns(columns, cfg: Config) -> list[str]:
    """Mapped columns a file lacks, apart from the optional ones."""
    return [c for c in cfg.column_map if c not in columns and c not in cfg.optional_columns]


def _read_group(
    spark: SparkSession, paths: list[str], columns: list[str], cfg: Config, multi_line: bool
) -> DataFrame:
    name = _export_name(F.col("_metadata.file_path"))
    # the day in UTC, whatever the session's zone
    day = F.floor(F.unix_seconds(F.col("_metadata.file_modification_time")) / 86_400).cast("int")
    modified = F.date_format(F.date_from_unix_date(day), "yyyy-MM-dd")
    raw = spark.read.schema(text_schema(columns)).options(**csv_options(multi_line)).csv(paths).select(
        "*", name.alias("source_file"), modified.alias("_modified")
    )
    cleaned = raw.withColumns({
        c: F.when(~F.col(f"`{c}`").isin(*NULL_WORDS), F.col(f"`{c}`")) for c in columns
    })
    renamed = cleaned.withColumnsRenamed({k: v for k, v in cfg.column_map.items() if k in columns})
    date = F.col(f"`{DATE_COLUMN}`") if DATE_COLUMN in columns else F.col("_modified")
    keep = [f for f in ("domain", *FIELDS) if f in renamed.columns]
    return renamed.select(
        *keep, provider_of(F.col("source_file"), cfg).alias("provider"), "source_file", date.alias("enriched_at")
    )


def read_exports(spark: SparkSession, folder: str, cfg: Config, multi_line: bool = True) -> DataFrame | None:
    """All exports below a folder as wide rows with provenance; None where there are none.

    Files are read together per distinct header, so a thousand files of one layout are one scan.
    Without `multi_line` no value may hold a line break, and large files are split between tasks.
    """
    paths = [f"{folder}/*.csv"]
    grouped = _headers(spark, paths)
    parts = []
    for header, files in sorted(grouped.items()):
        columns = _columns(spark, header)
        absent = missing_columns(columns, cfg)
        if absent:
            warnings.warn(f"{len(files)} export file(s) lack the columns {absent}", stacklevel=2)
        parts.append(_read_group(spark, sorted(files), columns, cfg, multi_line))
    if not parts:
        return None
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return wide.select(*[c for c in ("domain", *FIELDS, "provider", "source_file", "enriched_at") if c in wide.columns])
