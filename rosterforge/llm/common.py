"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of text handed to a Python worker at once.
BATCH_ROWS = 256
BATCH_BYTES = 16 << 20
#: Bytes of one text that are cut into words at once.
PIECE = 4 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds: whole texts may be long, and the default is 10,000 rows."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def id_schema(df: DataFrame, id_col: str, rest: str) -> T.StructType:
    """The id column as it is, of whatever type, and the fields of `rest`."""
    return T.StructType([T.StructField(id_col, df.schema[id_col].dataType), *T.StructType.fromDDL(rest).fields])


def free_name(name: str, columns: list[str]) -> str:
    """The name, with underscores added until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def hash_order(*cols: str, seed: int = 0) -> Column:
    """A reproducible order that has nothing to do with the data's own."""
    return F.xxhash64(*cols, F.lit(seed))


def smallest_by_hash(rows: DataFrame, k: int, order: Column, *ties: str, group: str | None = None) -> DataFrame:
    """The k rows with the smallest `order` (a 64-bit hash) of the table, or of each of its few groups.

    The table is read three times and should be stored. Groups are counted first, and only rows whose hash is
    below the share of about 2 k rows are brought together, so what one task reads does not grow with
    the number of tasks. Hashes that fall unevenly (many rows of one hash) only let more rows or all pass.
    """
    keys = F.lit(0) if group is None else F.col(group)
    sizes = rows.groupBy(keys.alias("_group")).count().collect()
    few, at = [], 2 * k + 64
    for size in sizes:
        own = keys.eqNullSafe(F.lit(size["_group"]))
        if size["count"] > 2 * at:
            below = own & (order < F.lit(-(1 << 63) + (1 << 64) * at // size["count"]))
            if rows.filter(below).count() >= k:
                own = below
        few.append(rows.filter(own).orderBy(order, *ties).limit(k))
    return reduce(DataFrame.unionByName, few) if few else rows.limit(0)


def rows_that_may_match(rows: DataFrame, wanted: DataFrame, *keys: str, bits: int = 24) -> DataFrame:
    """The rows whose keys may be among the wanted ones: a cheap sieve ahead of a join that shuffles texts.

    The wanted keys set 2**bits bits, a table of at most a quarter of a million numbers that is broadcast,
    whatever the sizes of the two sides. A bit set by chance lets one more row pass.
    """
    cell = F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)
    at, bit = F.shiftright(cell, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), cell.bitwiseAND(63).cast("int"))
    table = wanted.select(at.alias("_at"), bit.alias("_bit")).groupBy("_at").agg(F.bit_or("_bit").alias("_bits"))
    found = rows.join(F.broadcast(table), at == table["_at"]).filter(F.col("_bits").bitwiseAND(bit) != 0)
    return found.drop("_at", "_bits")


def parts_for(rows: int, per_part: int) -> int:
    return max(1, -(-int(rows) // per_part))


def pieces(data: bytes) -> Iterator[bytes]:
    """The text cut at white space into pieces of about PIECE bytes; every word stays whole."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + PIECE) if at + PIECE < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end
