"""Nested data (2.11): structs, arrays of structs, explode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pack(df: DataFrame, columns: Sequence[str], name: str, drop: bool = True) -> DataFrame:
    """Put ``columns`` (names or struct columns) into a struct ``name``.

    Calling it twice nests: pack the contributions, then pack that struct with
    the total.  Columns are chosen by name, so none is lost by position.
    """
    packed = df.withColumn(name, F.struct(*[F.col(c) for c in columns]))
    return packed.drop(*[c for c in columns if c != name]) if drop else packed


def unpack_field(df: DataFrame, path: str, alias: str | None = None) -> DataFrame:
    """Add the field at a dotted path as a top-level column.

    Works through arrays of structs too (``payments.contributions.tip_amount``
    on an array gives the array of tips, N6).
    """
    return df.select("*", F.col(path).alias(alias or path.split(".")[-1]))


def unpack_all(df: DataFrame, struct_col: str, prefix: str = "") -> DataFrame:
    """Add every field of a struct as a column.

    A field whose name is already taken gets ``prefix`` (or the struct's name)
    in front, so the result never has two columns of one name.
    """
    dtype = df.schema[struct_col].dataType if "." not in struct_col else df.select(struct_col).schema[0].dataType
    taken = set(df.columns)
    cols = []
    for field in dtype.fields:
        name = field.name
        if name in taken:
            name = f"{prefix or struct_col.split('.')[-1] + '_'}{name}"
        cols.append(F.col(f"{struct_col}.{field.name}").alias(name))
    return df.select("*", *cols)


def explode_rows(df: DataFrame, array_col: str, out: str | None = None, outer: bool = False) -> DataFrame:
    """One row per array element (N5); ``outer`` keeps empty and null arrays as a null row."""
    fn = F.explode_outer if outer else F.explode
    return df.withColumn(out or array_col, fn(F.col(array_col)))


def array_field(c: Column | str, field: str) -> Column:
    """A field projected over an array of structs."""
    column = F.col(c) if isinstance(c, str) else c
    return F.transform(column, lambda x: x.getField(field))


def nth_element(c: Column | str, index: int) -> Column:
    """Element ``index`` (0-based) of an array; null when the array is shorter."""
    column = F.col(c) if isinstance(c, str) else c
    return F.get(column, index)
