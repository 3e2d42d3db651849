"""Row-level feature expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paysight.config import SENIORITY_RULES, TRUE_TOKENS
from paysight.functions.parsing import parse_timestamp

# Unicode-aware whitespace, as Python's str.split() sees it.
_WS = r"(?U)[\s\x1c-\x1f]+"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_length(col: str | Column) -> Column:
    """characters in the text, NULL -> 0."""
    return F.length(F.coalesce(_c(col), F.lit("")))


def word_count(col: str | Column) -> Column:
    """whitespace-separated words, '' -> 0."""
    parts = F.split(F.coalesce(_c(col), F.lit("")), _WS)
    return F.size(F.filter(parts, lambda x: x != ""))


def int_flag(col: str | Column, tokens: list[str] = TRUE_TOKENS) -> Column:
    """boolean-like text -> 1 when its lower-case form is a truthy token, else 0."""
    return F.when(F.lower(_c(col).cast("string")).isin(*tokens), 1).otherwise(0)


def seniority_score(col: str | Column, rules=SENIORITY_RULES) -> Column:
    """F8: score of the first keyword group found (in rule order), else 0."""
    t = F.lower(F.coalesce(_c(col).cast("string"), F.lit("none")))
    expr = None
    for words, score in rules:
        cond = t.rlike(r"(?U)\b(" + "|".join(words) + r")\b")
        expr = F.when(cond, score) if expr is None else expr.when(cond, score)
    return expr.otherwise(0)


def posted_month(col: str | Column) -> Column:
    """month of the parsed date, NULL/unparsable -> 0."""
    return F.coalesce(F.month(parse_timestamp(col)), F.lit(0))


def log_target(col: str | Column) -> Column:
    """log1p transform of the target."""
    return F.log1p(_c(col))


def inverse_log_target(col: str | Column) -> Column:
    """expm1, back to USD."""
    return F.expm1(_c(col))


def fill_category(col: str | Column, fill: str = "unknown") -> Column:
    """C4: cast to string and replace NULL by 'unknown'."""
    return F.coalesce(_c(col).cast("string"), F.lit(fill))


def fill_text(col: str | Column) -> Column:
    """NULL text -> ''."""
    return F.coalesce(_c(col).cast("string"), F.lit(""))


def bool_code(col: str | Column) -> Column:
    """True 1, False 0, NULL -1 for a boolean-like text column."""
    lowered = F.lower(_c(col).cast("string"))
    return (F.when(lowered.isin("true", "t", "1"), 1)
            .when(lowered.isin("false", "f", "0"), 0)
            .otherwise(-1))
