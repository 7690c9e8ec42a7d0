"""Declared schemas: nothing in this package infers one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The input fields of the wine record in wire order, and the names model documents use for them.
WINE_FIELDS = [
    "fixed_acidity",
    "volatile_acidity",
    "citric_acid",
    "residual_sugar",
    "chlorides",
    "free_sulfur_dioxide",
    "total_sulfur_dioxide",
    "density",
    "pH",
    "sulphates",
    "alcohol",
]
WINE_NAMES = [
    "fixed acidity",
    "volatile acidity",
    "citric acid",
    "residual sugar",
    "chlorides",
    "free sulfur dioxide",
    "total sulfur dioxide",
    "density",
    "pH",
    "sulphates",
    "alcohol",
]

# Codes of the model kinds on the wire.
KIND_GRAPH = 0
KIND_BUNDLE = 1
KIND_DOCUMENT = 2
KIND_NAMES = {KIND_GRAPH: "TENSORFLOW", KIND_BUNDLE: "TENSORFLOWSAVED", KIND_DOCUMENT: "PMML"}

# Names of the marker results, and the extremes a statistics row starts from.
NO_MODEL = "No model available"
BAD_INPUT = "Bad input record"
LONG_MAX = 9223372036854775807
LONG_MIN = -9223372036854775808

RECORD = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("features", T.ArrayType(T.DoubleType())),
    ]
)

WINE_RECORD = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in WINE_FIELDS]
    + [T.StructField("data_type", T.StringType()), T.StructField("ts", T.LongType())]
)

MODEL = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("model_kind", T.IntegerType()),
        T.StructField("model", T.BinaryType()),
        T.StructField("location", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField("data_type", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("data", RECORD),
        T.StructField("model", MODEL),
    ]
)

RESULT = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("submission_ts", T.LongType()),
        T.StructField("result", T.DoubleType()),
    ]
)

STATS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("model_type", T.IntegerType()),
        T.StructField("since", T.LongType()),
        T.StructField("usage", T.LongType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("min", T.LongType()),
        T.StructField("max", T.LongType()),
    ]
)

# A parsed model. `form` says which of the other fields are set.
NODE = "struct<f:int,thr:double,strict:boolean,l:int,r:int,score:string,probs:array<double>>"
LAYER = "struct<w:array<array<double>>,b:array<double>,act:string>"
PARAM_FIELDS = {
    "form": "string",
    "labels": "array<string>",
    "intercept": "double",
    "coefs": "array<double>",
    "exponents": "array<double>",
    "link": "string",
    "depth": "int",
    "trees": f"array<array<{NODE}>>",
    "layers": f"array<{LAYER}>",
}
PARAMS = "struct<" + ",".join(f"{name}:{kind}" for name, kind in PARAM_FIELDS.items()) + ">"


def fields(**kinds: T.DataType) -> T.StructType:
    """A schema of nullable fields."""
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def ddl(schema: T.StructType) -> str:
    """The schema as a ``struct<...>`` type string, for casts."""
    return schema.simpleString()


def params_struct(**fields: Column) -> Column:
    """A full PARAMS value; fields left out are null."""
    return F.struct(
        *[
            fields.get(name, F.lit(None)).cast(kind).alias(name)
            for name, kind in PARAM_FIELDS.items()
        ]
    )


def linear_params(intercept: Column, coefs: list[Column]) -> Column:
    """The narrow value of a linear model: only what its scorer reads travels with the rows."""
    return F.struct(
        F.lit("linear").alias("form"),
        intercept.cast("double").alias("intercept"),
        F.array(*[c.cast("double") for c in coefs]).alias("coefs"),
    )
