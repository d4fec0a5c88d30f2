"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its own columns are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def orderable(kind: T.DataType) -> bool:
    """Whether rows can be sorted by a column of this type."""
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(orderable(field.dataType) for field in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(parts)).cast("int")


Table = TypeVar("Table")
_in_worker: dict[object, object] = {}


def worker_table(name: object, make: Callable[[], Table]) -> Table:
    """What tasks of one kind remember in a worker process from one task to the next.

    A worker holds one such table at a time: tasks of another kind drop it.
    """
    if name not in _in_worker:
        _in_worker.clear()
        _in_worker[name] = make()
    return _in_worker[name]
