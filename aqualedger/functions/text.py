"""String helpers with Oracle's empty-string-is-NULL rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_to_null(c: Column | str) -> Column:
    """Trim blanks on both sides; an all-blank value becomes NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.trim(col), F.lit(""))


def nvl(*cols: Column | str) -> Column:
    """First non-NULL value.  Empty strings are NULL only after landing has
    normalised them (``conform(blank_to_null=True)``)."""
    return F.coalesce(*[F.col(c) if isinstance(c, str) else c for c in cols])


def zero_if_null_sum(cols: list[Column | str]) -> Column:
    """``nvl(c1, 0) + ... + nvl(cn, 0)``: never NULL."""
    terms = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)) for c in cols]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out
