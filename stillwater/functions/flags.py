"""Flag text: a nullable, ``;``-separated set of labels."""
from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import TIDY_RULES


def contains(flag: Column, label: str) -> Column:
    """Substring test that is FALSE, never NULL, on a missing flag."""
    return F.coalesce(flag.contains(label), F.lit(False))


def contains_any(flag: Column, labels: Iterable[str]) -> Column:
    """One pattern for all labels (they hold no special characters)."""
    return F.coalesce(flag.rlike("|".join(re.escape(label) for label in labels)), F.lit(False))


def has_token(flag: Column, label: str) -> Column:
    """Whole-label test: "site visit window" does not hold "site visit"."""
    tokens = F.transform(F.split(flag, ";"), lambda t: F.trim(t))
    return F.coalesce(F.array_contains(tokens, label), F.lit(False))


def fold(flag: Column, rules: Iterable[tuple[str, Column]], separator: str = ";") -> Column:
    """Append each label whose condition is TRUE and which the flag does not hold yet.

    One expression for any number of rules. Labels must not contain one another.
    """
    added = [F.when(cond & ~contains(flag, label), F.lit(label)) for label, cond in rules]
    return F.nullif(F.concat_ws(separator, flag, *added), F.lit(""))


def ensure_column(df: DataFrame, name: str, default=None, dtype: str = "string") -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(default).cast(dtype))


def fold_flags(df: DataFrame, rules: Iterable[tuple[str, Column]], column: str = "flag",
               separator: str = ";") -> DataFrame:
    df = ensure_column(df, column)
    return df.withColumn(column, fold(F.col(column).cast("string"), rules, separator))


def add_flag(df: DataFrame, condition: Column, label: str, column: str = "flag") -> DataFrame:
    return fold_flags(df, [(label, condition)], column)


def tidied(flag: Column) -> Column:
    """Reduce to a governing label where there is one, then clean and sort the tokens."""
    whole = F.when(flag.isNull(), flag)
    for text, label in TIDY_RULES:
        whole = whole.when(flag.contains(text), F.lit(label))
    whole = whole.otherwise(flag)
    tokens = F.transform(F.split(F.regexp_replace(whole, "\n", " "), ";"), lambda t: F.trim(t))
    tokens = F.filter(tokens, lambda t: t != "")
    keyed = F.array_sort(F.transform(tokens, lambda t: F.struct(F.lower(t).alias("k"), t.alias("v"))))
    return F.nullif(F.array_join(F.transform(keyed, lambda s: s["v"]), ";"), F.lit(""))
