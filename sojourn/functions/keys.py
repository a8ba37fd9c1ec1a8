"""Key digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The digest input format.
NULL_TOKEN = "_dbt_null_"
SEPARATOR = "|-|"


def surrogate_key(*cols: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
