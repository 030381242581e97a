"""Table schemas, and the mapping from a typed record to a schema."""

from __future__ import annotations

import dataclasses
import typing

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _described(text: str):
    return dataclasses.field(metadata={"description": text})


@dataclasses.dataclass
class Position:
    """One observation of a token held by a protocol on a chain, in physical column order."""

    id: str = _described("Protocol that holds the token")
    chain_name: str = _described("Chain of the holding; a suffix marks borrowed amounts")
    date: int = _described("Time of the observation, seconds since 1970")
    token_name: str = _described("Symbol of the token")
    quantity: float = _described("Amount held, in units of the token")
    value_usd: float = _described("Amount held, in US dollars")


_SPARK_TYPES: dict[type, DataType] = {int: LongType(), str: StringType(), float: DoubleType()}


def schema_of(record: type) -> StructType:
    """Nullable Spark schema of a dataclass; descriptions become column comments, unknown types strings."""
    hints = typing.get_type_hints(record)
    schema = StructType()
    for field in dataclasses.fields(record):
        comment = field.metadata.get("description")
        schema.add(
            StructField(
                field.name,
                _SPARK_TYPES.get(hints[field.name], StringType()),
                True,
                {"comment": comment} if comment else None,
            )
        )
    return schema


FACTS = schema_of(Position)

EDGES = StructType(
    [
        StructField("time", TimestampType()),
        StructField("source", StringType()),
        StructField("target", StringType()),
        StructField("size", DoubleType()),
    ]
)

NODES = StructType(
    [
        StructField("time", TimestampType()),
        StructField("id", StringType()),
        StructField("size", DoubleType()),
        StructField("type", StringType()),
    ]
)

POOLS = StructType(
    [
        StructField("pool_id", StringType()),
        StructField("date", DateType()),
        StructField("token0", StringType()),
        StructField("token1", StringType()),
        StructField("tvl_usd", DoubleType()),
    ]
)

# amounts may be numbers, texts or integers beyond any type
_ENTRIES = "array<struct<date:bigint,tokens:map<string,string>>>"
TVL_DOCUMENT = f"id string, chainTvls map<string,struct<tokensInUsd:{_ENTRIES},tokens:{_ENTRIES}>>"


def as_facts(df: DataFrame) -> DataFrame:
    """Columns of ``FACTS`` by name, in physical order and type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACTS])
