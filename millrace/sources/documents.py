"""Nested JSON documents read by a schema whose names match whatever their case.

Writers of documents do not agree on the case of field names, and JSON readers take names by the
letter. The names that occur are found in one pass over the documents. Fields that all writers spell
alike are read by a scan of just these fields, also inside of nested arrays. Where spellings differ,
each document is parsed for all of them, and the one that it has gives the value: a scan resolves
its columns without regard to case and could not tell them apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import setting

EXACT_NAMES = ("spark.sql.caseSensitive", "true")


def _spellings(found: T.StructType, wanted: T.StructField) -> list[T.StructField]:
    """The fields of ``found`` that are ``wanted``, as it is spelled there first."""
    same = [f for f in found if f.name.lower() == wanted.name.lower()]
    return sorted(same, key=lambda f: (f.name != wanted.name, f.name))


def _read_as(found: T.DataType, wanted: T.DataType) -> T.DataType:
    """The wanted type with the names that occur in place of those asked for."""
    if isinstance(wanted, T.StructType):
        if not isinstance(found, T.StructType):
            return wanted
        fields = [
            T.StructField(f.name, _read_as(f.dataType, want.dataType))
            for want in wanted
            for f in _spellings(found, want)
        ]
        return T.StructType(fields)
    if isinstance(wanted, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(_read_as(found.elementType, wanted.elementType))
    return wanted


def _spelled_alike(read: T.DataType) -> bool:
    """Whether no two fields of one struct differ in case only."""
    if isinstance(read, T.ArrayType):
        return _spelled_alike(read.elementType)
    if not isinstance(read, T.StructType):
        return True
    names = {f.name.lower() for f in read}
    return len(names) == len(read) and all(_spelled_alike(f.dataType) for f in read)


def _renamed(value: Column, read: T.DataType, wanted: T.DataType) -> Column:
    """A value that was read under the names that occur, under the names asked for."""
    if isinstance(wanted, T.StructType) and isinstance(read, T.StructType):
        fields = [_field(lambda name: value.getField(name), read, want).alias(want.name) for want in wanted]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(wanted, T.ArrayType) and isinstance(read, T.ArrayType):
        return F.transform(value, lambda x: _renamed(x, read.elementType, wanted.elementType))
    return value


def _field(value_of, read: T.StructType, wanted: T.StructField) -> Column:
    found = [_renamed(value_of(f.name), f.dataType, wanted.dataType) for f in _spellings(read, wanted)]
    return F.coalesce(*found) if found else F.lit(None).cast(wanted.dataType)


def read_documents_any_case(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The fields of ``schema`` from JSON documents, one per line, with its names and order.

    A field that no document has is null. Of two spellings in one document the one that is asked
    for wins, then the first one in the order of letters. Malformed documents fail the read.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    with setting(spark, *EXACT_NAMES):
        found = spark.read.option("mode", "FAILFAST").option("primitivesAsString", True).json(path).schema
        read = _read_as(found, wanted)
        if _spelled_alike(read):
            rows = spark.read.option("mode", "FAILFAST").schema(read).json(path)
            fields = (_field(lambda name: F.col(f"`{name}`"), read, want).alias(want.name) for want in wanted)
        else:
            lines = spark.read.text(path).where(F.trim("value") != "")
            rows = lines.select(F.from_json("value", read, {"mode": "FAILFAST"}).alias("document"))
            document = F.col("document")
            fields = (_field(lambda name: document.getField(name), read, want).alias(want.name) for want in wanted)
        return rows.select(*fields)
