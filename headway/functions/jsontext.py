"""JSON text -> struct column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROKEN = "_broken"


def with_parsed(df: DataFrame, text: Column, schema: T.StructType, name: str) -> DataFrame:
    """Adds struct ``name``; its field ``_broken`` keeps text that did not
    parse.

    The struct comes out of an explode of one element. Filters on it cannot
    move below that, whereas a plain column would be parsed again for every
    field that a filter or a projection names.
    """
    full = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    parsed = F.from_json(text, full, options)
    return df.select("*", F.explode(F.array(parsed)).alias(name))
