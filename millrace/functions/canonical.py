"""One text for equal facts: keys in order at every depth, numbers in one form, so that digests of equal facts are equal whatever order they came in.

A number that is whole is written without a point (1, 1.0 and 1.00 are one number), others as the shortest decimal that reads back to them; struct fields and map keys are in byte order; an absent map key and a null
field differ, as in JSON. What the schema tells apart, the text does too: the text "1" is quoted, the number is not.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole doubles up to here are exact longs.
EXACT = 2.0**53


def quoted(x: Column) -> Column:
    """A text as JSON writes it."""
    held = F.to_json(F.array(x))
    return F.substr(held, F.lit(2), F.length(held) - 2)


def number(x: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):
        plain = x.cast("string")
        return F.when(F.contains(plain, F.lit(".")), F.regexp_replace(F.regexp_replace(plain, r"0+$", ""), r"\.$", "")).otherwise(plain)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        x = x.cast("string").cast("double") if isinstance(kind, T.FloatType) else x  # the decimal that a float is written as
        whole = (F.abs(x) <= EXACT) & (x == F.floor(x))
        return F.when(F.isnan(x) | (F.abs(x) == float("inf")), quoted(x.cast("string"))).when(whole, F.when(whole, x).cast("long").cast("string")).otherwise(x.cast("string"))
    return x.cast("string")


def canonical(x: Column, kind: T.DataType) -> Column:
    """The text of a column of any type; null for SQL's null is the text null."""
    if isinstance(kind, T.StructType):
        parts = [F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ":"), canonical(x.getField(f.name), f.dataType)) for f in sorted(kind, key=lambda f: f.name.encode())]
        made = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        made = F.concat(F.lit("["), F.array_join(F.transform(x, lambda e: canonical(e, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(x), lambda e: F.struct(e["key"].cast("string").alias("key"), canonical(e["value"], kind.valueType).alias("value")))
        made = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(entries), lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["value"])), ","), F.lit("}"))
    elif isinstance(kind, T.BooleanType):
        made = x.cast("string")
    elif isinstance(kind, T.NumericType):
        made = number(x, kind)
    elif isinstance(kind, T.BinaryType):
        made = quoted(F.base64(x))
    else:
        made = quoted(x.cast("string"))
    return F.coalesce(made, F.lit("null"))


def facts(rows: DataFrame, columns: Sequence[str]) -> Column:
    """The canonical text of some columns as one object."""
    kinds = {f.name: f for f in rows.schema}
    return canonical(F.struct(*[F.col(f"`{c}`").alias(c) for c in columns]), T.StructType([kinds[c] for c in columns]))


def digest(text: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(text, 256), 1, length)


def rewritten(text: str | None) -> str | None:
    """JSON text in canonical form; null where it is not JSON."""

    def form(x: object) -> object:
        if isinstance(x, dict):
            return {k: form(v) for k, v in x.items()}
        if isinstance(x, list):
            return [form(v) for v in x]
        if isinstance(x, Decimal):
            x = x.normalize()
            return int(x) if x == x.to_integral_value() and abs(x.adjusted()) < 40 else float(x)
        return x

    try:
        return json.dumps(form(json.loads(text, parse_float=Decimal)), ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    except (TypeError, ValueError):
        return None


@F.pandas_udf(T.StringType())
def canonical_json(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """For JSON texts whose schema is not known."""
    for part in texts:
        yield part.map(rewritten)
