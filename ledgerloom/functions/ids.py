"""Fact identifiers: a hash of the canonical key."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = ("scheme", "geo_level", "state_code", "district_code", "fin_year", "month", "metric")


def key_text(*columns: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


@F.pandas_udf(T.StringType())
def _blake2b_64(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: hashlib.blake2b(t.encode("utf-8"), digest_size=8).hexdigest())


def fact_id(blake: bool = False) -> Column:
    """16 hex characters over the canonical key columns.

    The default stays in the JVM (SHA-256, first 16 characters). ``blake=True`` gives the 64-bit
    BLAKE2b digest that published files carry, through an Arrow-batched function.
    """
    text = key_text(*[F.col(c) for c in KEY])
    return _blake2b_64(text) if blake else F.substring(F.sha2(text, 256), 1, 16)
