"""Exploding and settling rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin.session import checkpoint_dir


def explode_once(df: DataFrame, keep: Sequence[str], array: Column, pos: str, value: str) -> DataFrame:
    """One row per array element, numbered from 0.

    A plain explode makes Catalyst infer a filter on the array's size, which evaluates a
    computed array a second time below the generator; the outer form does not.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(pos, value)).where(F.col(pos).isNotNull())


def settle(df: DataFrame) -> DataFrame:
    """Write rows once to the shared checkpoint folder and go on from there.

    For narrow rows that were costly to compute and are read more than once.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def store(df: DataFrame) -> DataFrame:
    """Write rows once as files and read them back: their size is known then, so that few rows are broadcast by it."""
    path = f"{checkpoint_dir(df.sparkSession)}/bulletin-rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
