"""What is wrong with a JSON record, path by path, beside what can be read of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .events import decode_events

PROBLEM, FAULTS = "json_problem", "json_faults"
_TREE = "__tree"
_FAULT = "array<struct<path:string,found:string,value:string>>"
_NUMBERS = ["BIGINT", "DOUBLE", "FLOAT", "DECIMAL"]
#: Numbers by the kind they mostly have: JSON writes fractions as decimals.
_WHOLE, _NUMBER = "BIGINT", "DECIMAL"


def decode_rescued(records: DataFrame, schema: T.StructType) -> DataFrame:
    """``decode_events`` with two more columns on what did not fit.

    ``json_problem`` is ``not json`` for a text that is none (cut off, say),
    ``not an object`` for other JSON, else null.  ``json_faults`` lists each path
    whose type does not fit, with the type found and the value as text; the rest
    of the event is decoded as usual, and what can be read as the type asked for
    is kept too.  A whole number fits where a fraction is asked for, and a
    fraction of nothing (15.0) where a whole number is.  Missing fields, nulls
    and fields the schema does not name are no faults; a null record is not JSON.
    Extra columns of ``records`` are not read.
    """
    # The tree is a column of its own and each value's type is found once: one parse a record, one look a field.
    trees = records.withColumn(_TREE, F.try_parse_json(F.col("value").cast("string")))
    tree = F.col(_TREE)
    an_object = F.col("value").cast("string").rlike(r"^[ \t\r\n]*\{")
    problem = F.when(tree.isNull(), "not json").when(~an_object, "not an object")
    faults = F.when(problem.isNull(), _faults(tree, schema, "$", "")).otherwise(_none())
    marked = trees.select("*", problem.alias(PROBLEM), faults.alias(FAULTS)).drop(_TREE)
    return decode_events(marked, schema, keep=[PROBLEM, FAULTS])


def _none() -> Column:
    return F.array().cast(_FAULT)


def _faults(tree: Column, dtype: T.DataType, at: str, path: str) -> Column:
    """The faults below ``at`` in a tree, in the order of the schema."""
    found, values = [], []
    for here, name, want, inner in _checks(dtype, at, path):
        value = F.try_variant_get(tree, here, "variant")
        values.append(F.struct(F.lit(name).alias("path"), F.lit(want).alias("want"), value.alias("value")))
        if inner is not None:
            items = F.try_variant_get(tree, here, "array<variant>")
            below = F.flatten(F.transform(items, lambda item: _faults(item, inner, "$", f"{name}[]")))
            found += [_unfit(values), F.coalesce(below, _none())]
            values = []
    return F.concat(*found, *([_unfit(values)] if values else []))


def _checks(dtype: T.DataType, at: str, path: str):
    """Each value the schema names: where it is, its path as text, its kind, and the type of its items."""
    if isinstance(dtype, T.StructType):
        if path:
            yield at, path, "OBJECT", None
        for f in dtype.fields:
            yield from _checks(f.dataType, f"{at}['{f.name}']", f"{path}.{f.name}" if path else f.name)
    elif isinstance(dtype, T.ArrayType):
        yield at, path, "ARRAY", dtype.elementType
    elif isinstance(dtype, T.StringType):
        yield at, path, "STRING", None
    elif isinstance(dtype, T.BooleanType):
        yield at, path, "BOOLEAN", None
    else:
        yield at, path, _WHOLE if isinstance(dtype, T.IntegerType) else _NUMBER, None


def _unfit(values: list[Column]) -> Column:
    """Of values with the kind each should have, those that have another; most are done with after one look."""
    others = F.filter(F.array(*values), lambda v: _kind(v["value"]) != v["want"])
    kinds = F.transform(others, lambda v: F.struct(v["path"], v["want"], v["value"], _kind(v["value"]).alias("found")))
    unfit = F.filter(kinds, lambda v: (v["found"] != "VOID") & ~_fits(v))
    return F.transform(unfit, lambda v: F.struct(v["path"], v["found"], F.to_json(v["value"]).alias("value"))).cast(_FAULT)


def _kind(tree: Column) -> Column:
    """The JSON type without its parameters; null for nothing."""
    return F.substring_index(F.substring_index(F.schema_of_variant(tree), "<", 1), "(", 1)


def _fits(v: Column) -> Column:
    whole = F.try_variant_get(v["value"], "$", "double") % 1 == 0
    number = (v["want"] == _NUMBER) | ((v["want"] == _WHOLE) & whole)
    return v["found"].isin(_NUMBERS) & number
