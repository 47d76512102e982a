"""A nested answer cut down by its schema: blocks are left out at any depth of structs, arrays and maps, fields that a reader must see are kept wherever they stand, and what was left out is named.

The schema is walked once on the driver; what comes of it is one expression of struct() and transform() that runs inside the row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Test = Callable[[Column], Column]


@dataclass(frozen=True)
class Blocks:
    """of: the block that a field of this name belongs to. trust: a pattern of the names that are never left out (a field kept by it is kept whole). whole: blocks of which nothing is kept. top: names that are blocks only in
    the outermost object and the objects that are its fields."""

    of: Mapping[str, str]
    trust: str
    whole: frozenset[str] = frozenset()
    top: frozenset[str] = field(default_factory=frozenset)

    def trusted(self, name: str) -> bool:
        return re.search(self.trust, name) is not None


def trust_only(x: Column, kind: T.DataType, blocks: Blocks) -> Column | None:
    """What is kept of a block that is left out: its trusted fields at any depth; no column where the schema has none, null where a row has none."""
    if isinstance(kind, T.StructType):
        kept = []
        for f in kind:
            made = x.getField(f.name) if blocks.trusted(f.name) else trust_only(x.getField(f.name), f.dataType, blocks)
            if made is not None:
                kept.append(made.alias(f.name))
        return F.when(F.coalesce(*[F.when(c.isNotNull(), F.lit(1)) for c in kept]).isNotNull(), F.struct(*kept)) if kept else None
    if isinstance(kind, T.ArrayType):
        holder: list[bool] = []

        def one(e: Column) -> Column:
            made = trust_only(e, kind.elementType, blocks)
            holder.append(made is not None)
            return F.lit(0) if made is None else made

        rows = F.array_compact(F.transform(x, one))
        return F.when(F.size(rows) > 0, rows) if holder[0] else None
    return None


def in_field(name: str, there: Test) -> Test:
    return lambda v: F.coalesce(there(v.getField(name)), F.lit(False))


def in_some(there: Test, values: Test = lambda v: v) -> Test:
    return lambda v: F.exists(values(v), lambda e: there(e))


def cut(x: Column, kind: T.DataType, omit: frozenset[str], blocks: Blocks, depth: int = 0) -> tuple[Column, list[tuple[str, Test]]]:
    """The column without the blocks in omit, and for each field left out its block and whether a row has it."""
    if isinstance(kind, T.ArrayType):
        inner: list = []

        def one(e: Column) -> Column:
            made, gone = cut(e, kind.elementType, omit, blocks, depth + 1)
            inner[:] = gone
            return made

        made = F.transform(x, one)
        return made, [(b, in_some(there)) for b, there in inner]
    if isinstance(kind, T.MapType):
        inner = []

        def value(_: Column, v: Column) -> Column:
            made, gone = cut(v, kind.valueType, omit, blocks, depth + 1)
            inner[:] = gone
            return made

        made = F.transform_values(x, value)
        return made, [(b, in_some(there, F.map_values)) for b, there in inner]
    if not isinstance(kind, T.StructType):
        return x, []
    kept, gone = [], []
    for f in kind:
        at, block = x.getField(f.name), blocks.of.get(f.name)
        if block in omit and not blocks.trusted(f.name) and not (f.name in blocks.top and depth > 1):
            gone.append((block, in_field(f.name, lambda v: v.isNotNull())))
            rest = None if block in blocks.whole else trust_only(at, f.dataType, blocks)
            if rest is not None:
                kept.append(rest.alias(f.name))
        elif blocks.trusted(f.name):
            kept.append(at.alias(f.name))
        else:
            made, below = cut(at, f.dataType, omit, blocks, depth + 1)
            kept.append(made.alias(f.name))
            gone += [(b, in_field(f.name, there)) for b, there in below]
    made = F.struct(*kept) if kept else F.lit(None).cast("struct<>")
    return F.when(x.isNotNull(), made), gone


def compact(rows: DataFrame, column: str, blocks: Blocks, include: frozenset[str] = frozenset(), left_out: str = "left_out") -> DataFrame:
    """rows with the column cut down, and the blocks that each row had and has no more, in order. include: blocks that stay. Unknown names in include are an error."""
    known = frozenset(blocks.of.values())
    if wrong := sorted(include - known):
        raise ValueError(f"unknown blocks {', '.join(wrong)}; known: {', '.join(sorted(known))}")
    made, gone = cut(F.col(f"`{column}`"), rows.schema[column].dataType, known - include, blocks)
    names = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(there(F.col(f"`{column}`")), F.lit(b)) for b, there in gone])))) if gone else F.array().cast("array<string>")
    return rows.withColumns({left_out: names, column: made})
