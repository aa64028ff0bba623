"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.arithmetic import ColumnOrName, as_column

# Fixed value: the text hashed for a NULL field. Keys depend on its exact bytes.
NULL_FIELD = "_dbt_utils_surrogate_key_null_"


def surrogate_key(fields: Sequence[ColumnOrName], nulls_as_empty: bool = False) -> Column:
    """md5 of the fields as text, joined by ``-``.

    The join is not injective: a ``-`` inside a field can make two different rows
    share a key. ``nulls_as_empty`` gives the keys of the older scheme.
    """
    blank = F.lit("" if nulls_as_empty else NULL_FIELD)
    return F.md5(F.concat_ws("-", *[F.coalesce(as_column(c).cast("string"), blank) for c in fields]))
