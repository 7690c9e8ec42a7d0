"""Request and response bodies of an external scorer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modelstream.functions.features import argmax

# The signature the scorer is called with, and the name its results carry.
SIGNATURE = "predict"
REMOTE_NAME = "TensorFlow Model Serving"
RESPONSE = "struct<predictions:array<array<double>>>"


def predict_request(inputs: Column) -> Column:
    """The JSON body that asks for a prediction of one vector."""
    instance = F.struct(inputs.cast("array<double>").alias("inputs"))
    return F.to_json(
        F.struct(F.lit(SIGNATURE).alias("signature_name"), F.array(instance).alias("instances"))
    )


def first_prediction(body: Column) -> Column:
    """The score array of the first prediction; null for a body that is no response."""
    return F.get(F.from_json(body, RESPONSE).getField("predictions"), 0)


def predicted_class(body: Column) -> Column:
    """Index of the best score in a response; null for a body that is no response."""
    scores = first_prediction(body)
    return F.when(F.size(scores) > 0, argmax(scores).cast("double"))
