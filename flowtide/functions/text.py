"""Text to terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, StructType

# fixed value: a term is a run of two or more letters, numbers or underscores of any script
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN), F.lit(0))


def joined_text(schema: StructType, columns: list[str] | None = None) -> Column:
    """The given (default: all) columns joined by blanks; NULL and the cell ``None`` count as empty.

    Floating-point numbers have two decimals, so that they print alike everywhere.
    """
    cells = []
    for name in columns or schema.names:
        fractional = isinstance(schema[name].dataType, FractionalType)
        text = (F.col(name).try_cast("decimal(38,2)") if fractional else F.col(name)).cast("string")
        cells.append(F.coalesce(F.when(text != "None", text), F.lit("")))
    return F.concat_ws(" ", *cells)

