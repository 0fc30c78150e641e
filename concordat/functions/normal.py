"""Unicode normalisation, which SQL lacks."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql.functions import pandas_udf


@pandas_udf("string")
def to_nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))
