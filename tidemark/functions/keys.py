"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text hashed in place of a NULL key part.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: str) -> Column:
    """md5 over the parts joined by '-'; NULL and '' give different keys."""
    return F.md5(F.concat_ws("-", *[
        F.coalesce(F.col(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts
    ]))


def version_id(key: Column, stamp: Column) -> Column:
    """Row id of one version of a key: md5 of 'key|timestamp'."""
    def text(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(""))

    return F.md5(F.concat(text(key), F.lit("|"), text(stamp)))
