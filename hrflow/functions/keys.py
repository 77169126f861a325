"""Hash keys derived from natural keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator and the null marker decide the resulting hex string.
KEY_SEPARATOR = "|"
NULL_MARKER = "_NULL_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*fields: Column | str) -> Column:
    """md5 hex over the fields as text. A null field counts as a marker, so the key is never null."""
    parts = [F.coalesce(_col(f).cast("string"), F.lit(NULL_MARKER)) for f in fields]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def surrogate_key_if(field: Column | str) -> Column:
    """Like :func:`surrogate_key` for one field, but null stays null."""
    return F.when(_col(field).isNotNull(), surrogate_key(field))
