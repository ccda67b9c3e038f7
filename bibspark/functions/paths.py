"""Leaves: one column expression for a dotted path, through any depth of structs and arrays.

The array case yields all leaf values of a record in one flat array. Elements of one array are not
tied to elements of a sibling array, so two conditions on one array may hold on two elements.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Leaf(NamedTuple):
    col: Column
    many: bool
    dtype: T.DataType

    @property
    def values(self) -> Column:
        """The non-null values as an array; an absent leaf gives an empty array."""
        arr = self.col if self.many else F.array(self.col)
        return F.coalesce(F.array_compact(arr), F.array().cast(T.ArrayType(self.dtype)))

    @property
    def distinct(self) -> Column:
        return F.array_distinct(self.values)

    def map(self, fn) -> "Leaf":
        """Apply a column function to every value."""
        return self._replace(col=F.transform(self.col, fn) if self.many else fn(self.col))

    def any(self, test) -> Column:
        """True if some value passes; NULL or false otherwise."""
        return F.exists(self.col, test) if self.many else test(self.col)


def _flat(col: Column) -> Column:
    # flatten() is NULL as soon as one inner array is NULL
    return F.flatten(F.filter(col, lambda x: x.isNotNull()))


def leaf(df: DataFrame | T.StructType, path: str) -> Leaf:
    """Bind a dotted path to the schema of a frame."""
    dtype = df if isinstance(df, T.StructType) else df.schema
    col, many = None, False
    for part in path.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            raise ValueError(f"unknown path {path!r}: no field {part!r}")
        dtype = dtype[part].dataType
        col = F.col(f"`{part}`") if col is None else col.getField(part)
        while isinstance(dtype, T.ArrayType):
            if many:
                col = _flat(col)
            dtype, many = dtype.elementType, True
    return Leaf(col, many, dtype)


def value(col: Column | str, dtype: T.DataType | None = None) -> Leaf:
    """A leaf over any scalar expression."""
    return Leaf(F.col(col) if isinstance(col, str) else col, False, dtype or T.StringType())


def values(col: Column | str, dtype: T.DataType | None = None) -> Leaf:
    """A leaf over any array expression."""
    return Leaf(F.col(col) if isinstance(col, str) else col, True, dtype or T.StringType())
