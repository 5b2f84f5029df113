"""Results kept as loosely typed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANGES = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}
_NUMBER = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"


def read_documents(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON documents, one on a line, in ``schema``; never fails on a value.

    Each number is read by its own type, so longs are exact beside doubles. A wanted
    number that is missing, null or not a number is 0 (text is never a number), one
    beyond the wanted type is held to its range, and fractions are cut off. Text that
    is missing is NULL. A line that is no document has nothing.
    """
    document = F.explode(F.array(F.try_parse_json("value"))).alias("document")
    parsed = spark.read.text(path).select(document)
    return parsed.select(*[_field(F.col("document"), f).alias(f.name) for f in schema])


def _field(document: Column, field: T.StructField) -> Column:
    path = f"$.{field.name}"

    def as_type(kind: str) -> Column:
        return F.try_variant_get(document, path, kind)

    if not isinstance(field.dataType, T.NumericType):
        return as_type(field.dataType.simpleString())
    kind = F.schema_of_variant(as_type("variant"))
    double = as_type("double")
    if isinstance(field.dataType, T.FractionalType) and not isinstance(
        field.dataType, T.DecimalType
    ):
        value = double.cast(field.dataType)
    else:
        # Longs and decimals by their digits, without the fraction; the rest as a double.
        digits = F.split_part(as_type("string"), F.lit("."), F.lit(1)).try_cast("decimal(38,0)")
        exact = F.when(~kind.rlike("^(FLOAT|DOUBLE)"), _held(digits, field.dataType))
        value = F.coalesce(exact, _held(double, field.dataType))
    number = F.when(kind.rlike(_NUMBER), value)
    return F.coalesce(number, F.lit(0).cast(field.dataType))


def _held(value: Column, wanted: T.DataType) -> Column:
    """A number without its fraction, held to the range of a whole-number type."""
    whole = value - value % 1
    if not isinstance(wanted, tuple(_RANGES)):
        return F.when(~F.isnan(value.cast("double")), whole.try_cast(wanted))
    bits = _RANGES[type(wanted)]
    low, high = (F.lit(x).cast(wanted) for x in (-(2**bits), 2**bits - 1))
    beyond = F.when(F.isnan(value.cast("double")), F.lit(0).cast(wanted))
    beyond = beyond.when(value >= float(2**bits), high).when(value <= float(-(2**bits)), low)
    return beyond.otherwise(whole.try_cast(wanted))


def coerce_numbers(documents: DataFrame, schema: T.StructType) -> DataFrame:
    """A frame of documents in ``schema``, by the rules of ``read_documents``.

    Here each column has one type already, so a column that was read as double has
    lost what a double cannot hold.
    """
    return documents.select(*[_value(documents, field).alias(field.name) for field in schema])


def _value(documents: DataFrame, field: T.StructField) -> Column:
    present = documents.schema[field.name].dataType if field.name in documents.columns else None
    if not isinstance(field.dataType, T.NumericType):
        value = F.lit(None) if present is None else F.col(field.name)
        return value.cast(field.dataType)
    zero = F.lit(0).cast(field.dataType)
    if not isinstance(present, T.NumericType):
        return zero
    value = F.col(field.name)
    if isinstance(field.dataType, T.IntegralType | T.DecimalType):
        return F.coalesce(_held(value, field.dataType), zero)
    return F.coalesce(value.try_cast(field.dataType), zero)
