"""Reading the corpus tables, cutting lineage with tables written to the cluster's shared folder, and names for temporary columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import forget, settle, table  # noqa: F401


def unused(df: DataFrame, *names: str) -> list[str]:
    """A name for each temporary column that no column of ``df`` has, whatever the case of its letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def row_hash(df: DataFrame) -> Column:
    """A hash of a whole row; columns with maps, which have no hash of their own, take part as JSON."""
    return F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, t in df.dtypes])
