"""User functions: registration by name, typed pairs, table functions."""

from __future__ import annotations

import re

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_to_int(s: Column) -> Column:
    """Text to integer; NULL stays NULL, bad text is an error."""
    return s.cast("int")


def int_to_text(n: Column) -> Column:
    return n.cast("string")


@F.pandas_udf(T.StringType())
def event_fields(props: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """``k:v,...`` text from JSON, set up once per task (open) and run per batch (eval)."""
    import json

    def one(text):
        if text is None:
            return None
        return ",".join(f"{k}:{v}" for k, v in json.loads(text).items())

    for batch in props:
        yield batch.map(one)


@F.udtf(returnType=T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("token", T.StringType())]))
class Tokens:
    """One row per word of a text, counting from 1."""

    def eval(self, text: str):
        for pos, token in enumerate((text or "").split(), start=1):
            yield pos, token


def register(spark: SparkSession) -> None:
    """Session functions; a registered name is found before a catalog one."""
    spark.udf.register("event_fields", event_fields)
    spark.udtf.register("tokens", Tokens)


def rule_predicate(rule: str) -> Column:
    """A rule kept as data: ``getValue(data) > 10`` style text becomes a Column; ``getValue(x)`` is the field x."""
    return F.expr(re.sub(r"\bgetValue\s*\(([^()]*)\)", r"(\1)", rule))
