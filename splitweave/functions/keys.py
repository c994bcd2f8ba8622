"""Customer key and bucket expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "customer_user_id"
BUCKET = "id_bucket"
BUCKETS = 256


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_of(key: Column | str, n: int = BUCKETS) -> Column:
    """Stable bucket 0..n-1 of a key. The key's type is part of the hash; NULL keys share one bucket."""
    return F.pmod(F.xxhash64(as_column(key)), F.lit(n)).cast("int")


def find_column(names: list[str], wanted: str) -> str | None:
    """The name in ``names`` equal to ``wanted`` in any case; an exact match wins."""
    if wanted in names:
        return wanted
    same = [c for c in names if c.lower() == wanted.lower()]
    if len(same) > 1:
        raise ValueError(f"{wanted} matches several columns: {same}")
    return same[0] if same else None


def require_same_key_type(left: DataFrame, right: DataFrame, key: str) -> None:
    """Keys of different types fall into different buckets, so joining them is refused."""
    a, b = left.schema[key].dataType, right.schema[key].dataType
    if a != b:
        raise TypeError(f"{key} is {a.simpleString()} on one side and {b.simpleString()} on the other")
