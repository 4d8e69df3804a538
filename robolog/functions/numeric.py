"""Column functions for numbers in nested values and fixed-width vectors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed value: what counts as a number inside text.
NUMBER_PATTERN = r"[-+]?\d*\.?\d+(?:[eE][-+]?\d+)?"


def extract_numbers(text: Column) -> Column:
    """All numbers in a string, in order; null text has none."""
    tokens = F.regexp_extract_all(text, F.lit(f"({NUMBER_PATTERN})"), F.lit(1))
    # Text without a digit, the common case, is only looked at once.
    some = F.when(text.rlike("[0-9]"), F.transform(tokens, lambda t: t.cast("double")))
    return F.coalesce(some, _no_numbers())


def _no_numbers() -> Column:
    return F.array().cast("array<double>")


def flatten_numeric(value: Column, dtype: T.DataType) -> Column:
    """Numbers of a nested value in depth-first order, as ``ARRAY<DOUBLE>``.

    The expression is built from the column type: a struct or map that has a ``data``
    member stands for that member alone, arrays are flattened, strings give the numbers
    written in them, numbers and booleans give themselves, anything else gives nothing.
    """
    if isinstance(dtype, T.StructType):
        if "data" in dtype.names:
            inside = flatten_numeric(value.getField("data"), dtype["data"].dataType)
        else:
            parts = [flatten_numeric(value.getField(f.name), f.dataType) for f in dtype.fields]
            inside = F.concat(_no_numbers(), *parts)
        return F.coalesce(F.when(value.isNotNull(), inside), _no_numbers())
    if isinstance(dtype, T.MapType):
        member = flatten_numeric(F.element_at(value, "data"), dtype.valueType)
        every = flatten_numeric(F.map_values(value), T.ArrayType(dtype.valueType))
        return F.coalesce(F.when(F.map_contains_key(value, "data"), member).otherwise(every), _no_numbers())
    if isinstance(dtype, T.ArrayType):
        inner = F.transform(value, lambda v: flatten_numeric(v, dtype.elementType))
        return F.coalesce(F.flatten(inner), _no_numbers())
    if isinstance(dtype, T.StringType):
        return extract_numbers(value)
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return F.when(value.isNotNull(), F.array(value.cast("double"))).otherwise(_no_numbers())
    return _no_numbers()


def flatten_lists(value: Column, dtype: T.DataType) -> Column:
    """The stricter flattening used when dimensions are checked: lists and scalars only."""
    if isinstance(dtype, T.ArrayType):
        inner = F.transform(value, lambda v: flatten_lists(v, dtype.elementType))
        return F.coalesce(F.flatten(inner), _no_numbers())
    if isinstance(dtype, (T.NumericType, T.BooleanType, T.StringType)):
        number = value.try_cast("double")
        return F.when(number.isNotNull(), F.array(number)).otherwise(_no_numbers())
    return _no_numbers()


def flatten_json(text: Column, schema: str) -> Column:
    """Numbers of a JSON payload with a known schema."""
    dtype = T.StructType.fromDDL(schema)
    # The lambda gives the parsed value a name, so the text is parsed once per row.
    flat = F.transform(F.array(F.from_json(text, dtype)), lambda v: flatten_numeric(v, dtype))
    return F.get(flat, F.lit(0))


def pad_vector(values: Column, width: int | Column) -> Column:
    """Exactly ``width`` float32 numbers: zeros are added, extra numbers are cut."""
    size = F.lit(width) if isinstance(width, int) else width
    have = F.coalesce(values.cast("array<float>"), F.array().cast("array<float>"))
    fill = F.array_repeat(F.lit(0.0).cast("float"), F.greatest(size - F.size(have), F.lit(0)))
    return F.slice(F.concat(have, fill), F.lit(1), size)


def to_vector(value: Column, dtype: T.DataType) -> Column:
    """A float32 vector: scalars become length one, a one-element outer list is unwrapped."""
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.ArrayType):
        return F.when(F.size(value) == 1, F.get(value, F.lit(0))).cast("array<float>")
    if isinstance(dtype, T.ArrayType):
        return value.cast("array<float>")
    return F.when(value.isNotNull(), F.array(value.cast("float")))


def checked_vector(vector: Column, width: int, label: str) -> Column:
    """The vector itself; the query fails where it is missing or of another width."""
    size = F.coalesce(F.size(vector), F.lit(-1))
    problem = F.when(vector.isNull(), F.lit(f"no {label} vector")).otherwise(
        F.concat(F.lit(f"{label} vector is "), size.cast("string"), F.lit(f" wide, not {width}"))
    )
    return F.when(size == width, vector).otherwise(F.raise_error(problem).cast("array<float>"))


def has_width(vector: Column, width: int) -> Column:
    """True where the vector is present and has the wanted width (for reject tables)."""
    return F.coalesce(F.size(vector) == width, F.lit(False))


def concat_vectors(*parts: Column) -> Column:
    """Parts one after another as float32; null when a part is missing."""
    return F.concat(*[p.cast("array<float>") for p in parts])


def vector_slice(vector: Column, start: int, length: int) -> Column:
    """``length`` numbers from zero-based ``start``."""
    return F.slice(vector, start + 1, length)


def float_castable(dtype: T.DataType) -> bool:
    """Whether a column can feed a float32 feature (integers, floats and lists of them)."""
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return isinstance(dtype, (T.FloatType, T.DoubleType, T.IntegralType, T.BooleanType))
