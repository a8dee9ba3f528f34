"""Joins of a large fact with a keyed table whose size is not known beforehand."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.workspace import stage


@dataclass(frozen=True)
class JoinBounds:
    """``broadcast_bytes``: largest measured table that is sent to every executor."""

    broadcast_bytes: int = 64 * 1024 * 1024


DEFAULT_BOUNDS = JoinBounds()


def _row_bytes(df: DataFrame):
    total = F.lit(16)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.lit(8) + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, T.DecimalType):
            total = total + F.lit(24)
        else:
            total = total + F.lit(8)
    return total.cast("bigint")


def fits_broadcast(tables: dict[str, DataFrame], bounds: JoinBounds = DEFAULT_BOUNDS) -> dict[str, bool]:
    """Measure all tables in one distributed job; each task returns one number per table.

    A database table has no size estimate in the plan, hence the measuring.
    """
    sizes = None
    for name, table in tables.items():
        size = table.agg(F.coalesce(F.sum(_row_bytes(table)), F.lit(0)).alias("bytes"))
        size = size.select(F.lit(name).alias("name"), "bytes")
        sizes = size if sizes is None else sizes.unionAll(size)
    return {row["name"]: row["bytes"] <= bounds.broadcast_bytes for row in sizes.collect()}


#: A table of nothing but keys that is too large as rows, but small with 64 keys to a row.
PACKED = "packed"
# A row header and two numbers, as above.
_WORD_BYTES = 16 + 8 + 8


def whole_numbers(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def key_words(table: DataFrame, key: str) -> DataFrame:
    """64 neighbouring keys to a row: ``__word``, their number without its last six bits, ``__keys``, a
    bit for each of them that the table holds, and ``__rows``. NULLs are left out."""
    known = table.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("bigint").alias("__key"))
    return known.groupBy(F.shiftright("__key", 6).alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(__key & 63))")).alias("__keys"), F.count(F.lit(1)).alias("__rows"),
    )


def fits_packed(table: DataFrame, bounds: JoinBounds = DEFAULT_BOUNDS) -> bool:
    """Whether ``table`` is one column of whole numbers, none of them twice, whose words are small enough to broadcast."""
    if len(table.columns) != 1 or not whole_numbers(table, *table.columns):
        return False
    seen = key_words(table, *table.columns).agg(
        F.count(F.lit(1)).alias("words"), F.sum("__rows").alias("rows"), F.sum(F.bit_count("__keys")).alias("keys")
    ).first()
    return seen["rows"] == seen["keys"] and seen["words"] * _WORD_BYTES <= bounds.broadcast_bytes


def _packed_join(fact: DataFrame, table: DataFrame, key: str) -> DataFrame:
    words = key_words(table, key).select("__word", "__keys")
    number = F.col(f"`{key}`").cast("bigint")
    found = fact.withColumn("__word", F.shiftright(number, 6)).join(F.broadcast(words), "__word")
    found = found.where(F.getbit("__keys", number.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return found.select(key, *[c for c in fact.columns if c != key])


def _shuffle_width(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Values of ``keys`` that hold more than a shuffle partition's worth of rows: column, key, copies.

    One job counts all the columns together, each in its own type, with partial sums before its
    shuffle, and writes the result. A column has fewer such values than there are shuffle partitions.
    """
    width = _shuffle_width(fact)
    column = F.coalesce(*[F.when(F.grouping(k) == 0, F.lit(k)) for k in keys])
    key = F.coalesce(*[F.col(k).cast("string") for k in keys])
    counts = fact.groupingSets([[F.col(k)] for k in keys], *keys).agg(
        column.alias("column"), key.alias("key"), F.count(F.lit(1)).alias("n")
    ).select("column", "key", "n")
    counts = stage(counts, "key-counts")
    rows = counts.groupBy("column").agg(F.sum("n").alias("rows"))
    hot = counts.where("key is not null").join(F.broadcast(rows), "column").where(F.col("n") * width > F.col("rows"))
    copies = F.greatest(F.lit(2), F.ceil(F.col("n") / F.col("rows") * width)).cast("int")
    return stage(hot.select("column", "key", copies.alias("copies")), "hot-keys")


def lookup_join(
    fact: DataFrame, table: DataFrame, key: str, table_key: str, *, small: bool | str, hot: DataFrame | None = None
) -> DataFrame:
    """Inner join ``fact.key = table.table_key``; the table's key column is dropped.

    ``small`` is the outcome of ``fits_broadcast``, or ``PACKED`` for a table that ``fits_packed`` and a
    fact whose key is a whole number too. Otherwise both sides are shuffled, whatever
    Spark thinks of the table's size, and rows of the ``hot`` values (see ``hot_keys``) are spread
    over several partitions. The table holds every copy of such a value, so any salt is right; it
    is a hash of the row and of the partition it was read in, for equal rows not to stay together.
    Without ``hot`` there is no salt, and rows are sorted by the key alone.
    """
    table = table.withColumnRenamed(table_key, key)
    if small == PACKED:
        return _packed_join(fact, table, key)
    if small:
        return fact.join(F.broadcast(table), key)
    if hot is None:
        return fact.join(table.hint("merge"), key)
    # Fewer rows than shuffle partitions, see hot_keys.
    salted = F.broadcast(hot.where(F.col("column") == key).select(
        F.col("key").cast(fact.schema[key].dataType).alias(key), F.col("copies").alias("__copies")))
    spread = F.xxhash64(*fact.columns, F.spark_partition_id())
    salted_fact = fact.join(salted, key, "left").withColumn(
        "__salt", F.coalesce(F.pmod(spread, F.col("__copies")).cast("int"), F.lit(0))
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("__copies"), F.lit(1)) - 1)
    salted_table = table.join(salted, key, "left").withColumn("__salt", F.explode(copies))
    return salted_fact.drop("__copies").join(
        salted_table.drop("__copies").hint("merge"), [key, "__salt"]
    ).drop("__salt")
