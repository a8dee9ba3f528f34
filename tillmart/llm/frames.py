"""Working on a table whose columns may have any names."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def numbered_columns(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named c0, c1, ... and the new name of each."""
    names = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.select([F.col(f"`{old}`").alias(new) for old, new in names.items()]), names


def named_columns(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """Back to the columns as they were."""
    return rows.select([F.col(new).alias(old) for old, new in names.items()])
