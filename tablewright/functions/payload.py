"""Inference requests and responses as JSON columns.

A request lists its inputs, each with a name, shape, datatype and data; a
response lists its outputs the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TENSOR = "struct<name:string,shape:array<int>,datatype:string,data:array<double>>"
RESPONSE = f"struct<model_name:string,outputs:array<{TENSOR}>>"


def _tensor(name: str, value: Column, datatype: str) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        F.array(F.lit(1), F.lit(1)).alias("shape"),
        F.lit(datatype).alias("datatype"),
        F.array(value.cast("double")).alias("data"),
    )


def request(columns: Sequence[str], datatype: str = "FP32") -> Column:
    """A row as a JSON request with one 1x1 input per column."""
    inputs = F.array(*[_tensor(c, F.col(c), datatype) for c in columns])
    return F.to_json(F.struct(inputs.alias("inputs")))


def response(values: Column, name: str = "output", datatype: str = "FP32") -> Column:
    """An array of numbers as a JSON response with one output."""
    tensor = F.struct(
        F.lit(name).alias("name"),
        F.array(F.lit(1), F.size(values)).alias("shape"),
        F.lit(datatype).alias("datatype"),
        values.cast("array<double>").alias("data"),
    )
    return F.to_json(F.struct(F.array(tensor).alias("outputs")))


def response_data(text: Column) -> Column:
    """The data of the first output of a JSON response; null if it has none."""
    outputs = F.from_json(text, RESPONSE)["outputs"]
    return F.try_element_at(outputs, F.lit(1))["data"]
