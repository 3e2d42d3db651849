"""Filters, projections and the engineered feature frame (C1-C9, F1-F10 applied)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysight.config import (CAT_COUNT_FEATURES, COLS, FEATURE_COLUMNS, OHE_FEATURES,
                             SALARY_MAX, SALARY_MIN, SKILLS_TEXT, TARGET_ENC_FEATURES,
                             TITLE_TEXT, Columns)
from paysight.functions import parsing as P
from paysight.functions import text as X


def target_column(rate: str = "year", cols: Columns = COLS) -> str:
    return cols.target if rate == "year" else cols.target_hour


def usable_target(df: DataFrame, target: str) -> DataFrame:
    """Keep rows whose target is present and positive."""
    return df.filter(F.col(target).isNotNull() & (F.col(target) > 0))


def cap_target(df: DataFrame, target: str, lo: float = SALARY_MIN,
               hi: float = SALARY_MAX) -> DataFrame:
    """Drop rows outside [lo, hi] (inclusive both ends)."""
    return df.filter(F.col(target).between(lo, hi))


def floor_target(df: DataFrame, target: str, lo: float = SALARY_MIN) -> DataFrame:
    """Drop rows below the floor; no upper cap."""
    return df.filter(F.col(target) >= lo)


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``members`` (left-semi join, no duplication)."""
    return df.join(members.select(key), on=key, how="left_semi")


def min_support(grouped: DataFrame, count_col: str, n: int) -> DataFrame:
    """Keep groups with at least ``n`` rows."""
    return grouped.filter(F.col(count_col) >= n)


def salaried(postings: DataFrame, rate: str = "year", cols: Columns = COLS) -> DataFrame:
    """C1 + F1-F4: usable-target rows with parsed skills and date."""
    target = target_column(rate, cols)
    df = usable_target(postings, target)
    skills = P.parse_skill_list(cols.skills)
    return (df.withColumn("skills_list", skills)
            .withColumn(SKILLS_TEXT, P.skills_text("skills_list"))
            .withColumn("n_skills", P.n_items("skills_list"))
            .withColumn(cols.posted, P.parse_timestamp(cols.posted)))


def engineered(df: DataFrame, cols: Columns = COLS) -> DataFrame:
    """Add the numeric, categorical and text feature columns."""
    title = F.col(cols.title)
    has_map = cols.type_skills in df.columns
    if has_map:
        df = df.withColumn("_tmap", P.parse_skill_map(cols.type_skills))
    out = df.select(
        "*",
        X.text_length(title).alias("title_len"),
        X.word_count(title).alias("title_word_count"),
        X.int_flag(cols.remote).alias("remote_flag"),
        X.int_flag(cols.no_degree).alias("no_degree_flag"),
        X.int_flag(cols.health).alias("health_flag"),
        X.seniority_score(title).alias("seniority_score"),
        (X.posted_month(cols.posted) if cols.posted in df.columns else F.lit(0))
        .alias("posted_month"),
        (P.skill_category_counts(cols.type_skills, parsed=F.col("_tmap")) if has_map
         else F.struct(*[F.lit(0).alias(c) for c in CAT_COUNT_FEATURES])).alias("_cats"),
    )
    out = (out.select("*", *[F.col("_cats")[c].alias(c) for c in CAT_COUNT_FEATURES])
           .drop("_cats", "_tmap"))
    fills = {c: X.fill_category(c) for c in OHE_FEATURES + TARGET_ENC_FEATURES
             if c in out.columns}
    fills[TITLE_TEXT] = X.fill_text(TITLE_TEXT)
    fills[SKILLS_TEXT] = (X.fill_text(SKILLS_TEXT) if SKILLS_TEXT in out.columns
                          else F.lit(""))
    return out.withColumns(fills)


def prepared(postings: DataFrame, cols: Columns = COLS) -> DataFrame:
    """Modelling frame: salaried, capped to the bounds, engineered."""
    df = cap_target(salaried(postings, "year", cols), cols.target)
    return engineered(df, cols)


def feature_projection(df: DataFrame, cols: Columns = COLS,
                       keep: list[str] | None = None) -> DataFrame:
    """The fixed 24 model inputs in order (plus id / target when asked)."""
    extra = keep if keep is not None else [cols.id, cols.target]
    return df.select(*extra, *FEATURE_COLUMNS)


def code_column(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """C8 (general form): category -> integer code by sorted distinct value, NULL -> -1.

    Codes are positions of the sorted distinct values (a distributed zipWithIndex,
    so a high-cardinality column never lands in one task), joined back.
    """
    from paysight.operators.split import global_position
    out = out or f"{col}_code"
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    codes = global_position(values, [col], out)
    return (df.join(codes, on=col, how="left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(-1))))


def code_bool(col: str | Column) -> Column:
    return X.bool_code(col)
