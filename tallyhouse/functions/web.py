"""Parts of a URL by plain text surgery.

These do not parse URLs. A scheme is removed wherever it stands, a fragment stays
in the path, and a parameter name also matches as the end of a longer name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.arithmetic import ColumnOrName, as_column


def _without(text: Column, *parts: str) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p), F.lit("")), parts, text)


def _before(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, 1)


def url_host(url: ColumnOrName) -> Column:
    """Text between the scheme and the first ``/`` or ``?``."""
    bare = _without(as_column(url), "android-app://", "http://", "https://")
    return _before(_before(bare, "/"), "?")


def url_path(url: ColumnOrName) -> Column:
    """Text after the first ``/`` and before ``?``, without the leading slash.

    With neither mark the whole text is the path. With only a ``?`` nothing is
    left, as the text then starts at the mark.
    """
    bare = _without(as_column(url), "http://", "https://")
    slash = F.instr(bare, "/")
    rest = F.substring(bare, slash + 1, F.length(bare))
    cut = F.when(slash > 0, rest).when(F.instr(bare, "?") > 0, F.lit("")).otherwise(bare)
    return F.when(bare.isNotNull(), _before(cut, "?"))


def url_parameter(url: ColumnOrName, name: str) -> Column:
    """Value after ``name=`` up to the next ``&``; NULL when absent or empty."""
    value = F.split_part(as_column(url), F.lit(f"{name}="), F.lit(2))
    return F.nullif(_before(value, "&"), F.lit(""))
