"""Record types. Field names follow the wire format of the landed JSON."""

from __future__ import annotations

from pyspark.sql import types as T

_strings = T.ArrayType(T.StringType())

RECIPE = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("ingredient", _strings),
    T.StructField("steps", _strings),
    T.StructField("images", _strings),
])

RESULT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("recipe", RECIPE),
])

# The status domain and its integer codes.
STATUS_CODES = {
    "default": 0,
    "success": 1,
    "failure": 2,
    "networkFailure": 4,
    "parseFailure": 8,
}

NODE = T.StructType([
    T.StructField("pre", T.IntegerType()),
    T.StructField("post", T.IntegerType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("classes", _strings),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("text_from", T.IntegerType()),
    T.StructField("text_to", T.IntegerType()),
    T.StructField("inner_from", T.IntegerType()),
    T.StructField("inner_to", T.IntegerType()),
])
