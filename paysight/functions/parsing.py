"""Parsing of list / map text columns and dates.

All built-in expressions (from_json + higher-order functions), so they stay in
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paysight.config import SKILL_CATEGORIES


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _tuple_to_list(text: Column) -> Column:
    """Python-literal tuple ``('a', 'b')`` / ``('a',)`` -> list text ``['a', 'b']``."""
    t = F.trim(text)
    t = F.regexp_replace(t, r"^\((.*)\)$", "[$1]")
    return F.regexp_replace(t, r",\s*\]$", "]")


def parse_skill_list(col: str | Column) -> Column:
    """list text -> array of trimmed lower-case strings; anything else -> []."""
    parsed = F.from_json(_tuple_to_list(_c(col)), "array<string>")
    return F.transform(F.coalesce(parsed, F.array().cast("array<string>")),
                       lambda x: F.lower(F.trim(x)))


def skills_text(skills: str | Column) -> Column:
    """items joined by one space."""
    return F.array_join(_c(skills), " ")


def n_items(skills: str | Column) -> Column:
    """list length, duplicates counted ([] -> 0)."""
    return F.size(_c(skills))


def parse_timestamp(col: str | Column, fmt: str | None = None) -> Column:
    """text -> timestamp; unparsable -> NULL (safe under ANSI mode)."""
    c = _c(col).cast("string")
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def split_comma_list(col: str | Column) -> Column:
    """"a, B,,c" -> [a, b, c] (trimmed, lower-cased, empties dropped)."""
    parts = F.transform(F.split(F.coalesce(_c(col), F.lit("")), ","),
                        lambda x: F.lower(F.trim(x)))
    return F.filter(parts, lambda x: x != "")


def _dedup_entries(entries: Column) -> Column:
    """Keys in first-seen order, each holding the value of its last occurrence.

    The quadratic pass runs only for rows that do have a repeated key."""
    keys = F.transform(entries, lambda e: e["key"])
    first = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, 1, i),
                                                     lambda p: p["key"] == e["key"]))
    deduped = F.transform(first, lambda e: F.struct(
        e["key"].alias("key"),
        F.try_element_at(F.filter(entries, lambda p: p["key"] == e["key"]), F.lit(-1))["value"]
        .alias("value")))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(deduped)


def parse_skill_map(col: str | Column) -> Column:
    """F10 first step: the typed parse (NULL when a value is not a list)."""
    return F.from_json(_tuple_to_list(_c(col)), "map<string,array<string>>")


def skill_category_counts(col: str | Column,
                          categories: list[str] = SKILL_CATEGORIES,
                          parsed: Column | None = None) -> Column:
    """structured skill map text -> struct of per-category counts.

    A known category assigns its count; an unknown one adds to ``other``, so an
    unknown key listed before ``other`` is overwritten by it and one listed after
    is added. ``n_skill_categories`` counts keys (unknown included) with items.
    Non-list values count 0; unparsable input gives all zeros.
    """
    text = _tuple_to_list(_c(col))
    empty = F.array().cast("array<struct<key:string,n:int>>")
    # fast path: every value is a list -> sizes straight from one parse (pass the
    # parse as its own column via ``parsed`` so it is evaluated once per row)
    fast = parsed if parsed is not None else F.from_json(text, "map<string,array<string>>")
    fast_entries = F.transform(_dedup_entries(F.map_entries(fast)), lambda e: F.struct(
        e["key"].alias("key"), F.size(e["value"]).alias("n")))
    # slow path (some value is not a list, which nulls the typed parse): values as
    # raw text, each re-parsed; a non-list value counts 0
    raw = F.from_json(text, "map<string,string>")
    slow_entries = F.transform(
        _dedup_entries(F.coalesce(F.map_entries(raw),
                                  F.array().cast("array<struct<key:string,value:string>>"))),
        lambda e: F.struct(e["key"].alias("key"), F.coalesce(
            F.size(F.from_json(e["value"], "array<string>")), F.lit(0)).alias("n")))
    entries = F.when(fast.isNotNull(), fast_entries).otherwise(
        F.coalesce(slow_entries, empty))
    known = F.array(*[F.lit(c) for c in categories])
    zero = F.struct(*[F.lit(0).alias(c) for c in categories], F.lit(0).alias("_n"))

    def step(acc: Column, e: Column) -> Column:
        n = F.when(e["n"].isNull() | (e["n"] < 0), 0).otherwise(e["n"])
        out = []
        for c in categories:
            if c == "other":
                v = (F.when(e["key"] == c, n)
                     .when(~F.array_contains(known, e["key"]), acc[c] + n)
                     .otherwise(acc[c]))
            else:
                v = F.when(e["key"] == c, n).otherwise(acc[c])
            out.append(v.alias(c))
        out.append((acc["_n"] + F.when(n > 0, 1).otherwise(0)).alias("_n"))
        return F.struct(*out)

    folded = F.aggregate(entries, zero, step)
    return F.struct(*[folded[c].cast("int").alias(f"cat_{c}") for c in categories],
                    folded["_n"].cast("int").alias("n_skill_categories"))
