"""Price adjustment for splits and dividends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OHL = ("open", "high", "low")


def adjustment_factor(close: Column, adjusted: Column) -> Column:
    """adjusted / close where both are known and close is not zero, else null."""
    return F.when(adjusted.isNotNull() & close.isNotNull() & (close != 0), adjusted / close)


def adjust(df: DataFrame, audit: bool = True) -> DataFrame:
    """Prices and volume on the adjusted scale, with the raw values beside them.

    Without both ``close`` and ``adjusted_close`` the rows stay as they are. Open, high and low change only
    if all three columns exist. Raw copies come before ``adjustment_factor``, in a fixed order.
    """
    names = set(df.columns)
    if not {"close", "adjusted_close"} <= names:
        return df
    factor = adjustment_factor(F.col("close"), F.col("adjusted_close"))
    new: dict[str, Column] = {"close": F.coalesce("adjusted_close", "close")}
    if set(OHL) <= names:
        new |= {c: F.when(F.col(c).isNotNull() & factor.isNotNull(), F.col(c) * factor).otherwise(F.col(c)) for c in OHL}
    if "volume" in names:
        new["volume"] = F.when(F.col("volume").isNotNull() & factor.isNotNull() & (factor != 0), F.col("volume") / factor).otherwise(F.col("volume").cast("double"))
    kept = [new.get(c, F.col(c)).alias(c) for c in df.columns]
    raw = [F.col(c).alias(f"raw_{c}") for c in ("close", *OHL, "volume") if c in names]
    return df.select(*kept, *(raw if audit else []), factor.alias("adjustment_factor"))
