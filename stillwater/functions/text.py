"""Text helpers shared by sites, notes and seasons."""
from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SEASONS, SITE_RENAMES


def matches(text: Column, pattern: str) -> Column:
    """Case-insensitive regex test, FALSE on NULL."""
    return F.coalesce(text.rlike(f"(?i){pattern}"), F.lit(False))


def replace_first(text: Column, literal: str, by: str | Column) -> Column:
    """Replace the first occurrence of a literal (NULL replacement gives NULL)."""
    by = F.lit(by) if isinstance(by, str) else by
    at = F.instr(text, literal)
    swapped = F.concat(F.substring(text, F.lit(1), at - 1), by,
                       F.substring(text, at + len(literal), F.length(text)))
    return F.when(at > 0, swapped).otherwise(text)


def standard_site(site: Column, renames: Iterable[tuple[str, str]] = SITE_RENAMES) -> Column:
    low = F.lower(site)
    out = F.when(low.isNull(), low)
    for old, new in renames:
        out = out.when(low.contains(old), F.regexp_replace(low, f"^(.*?){re.escape(old)}", f"$1{new}"))
    return out.otherwise(low)


def season_of(month: Column, seasons=SEASONS) -> Column:
    """``seasons``: mapping or pairs of label -> months."""
    pairs = seasons.items() if isinstance(seasons, dict) else seasons
    out = F.lit(None).cast("string")
    for label, months in reversed(list(pairs)):
        out = F.when(month.isin(*months), F.lit(label)).otherwise(out)
    return out
