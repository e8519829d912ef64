"""Canonical JSON, byte for byte."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def canonical_json(document: pd.DataFrame) -> pd.Series:
    """A struct as JSON with sorted keys, a blank after commas and colons, and everything beyond
    ASCII escaped: the bytes that are hashed.  Spark's own writer has other blanks and
    escapes, so this is an Arrow function.  Null fields are null; numbers stay integers."""

    def plain(value):
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return None
        if isinstance(value, dict):
            return {k: plain(v) for k, v in value.items()}
        if isinstance(value, (list, tuple)) or hasattr(value, "tolist") and getattr(value, "ndim", 0):
            return [plain(v) for v in value]
        if hasattr(value, "isoformat"):
            return value.isoformat()
        return int(value) if isinstance(value, float) and value.is_integer() else value.item() if hasattr(value, "item") else value

    return pd.Series([json.dumps({k: plain(v) for k, v in row.items()}, sort_keys=True) for row in document.astype(object).to_dict("records")], dtype="object")
