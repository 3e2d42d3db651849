"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as the contracts define them: runs of anything but space and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"
#: Arrow batches end at this size, whatever the row count (very long texts).
BATCH_BYTES = 4 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    """A null text counts as the empty one."""
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of a frame by exact name (names may hold dots or spaces)."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def unused(df: DataFrame, name: str) -> str:
    """A name like this one that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_fold(col: str = "doc_id", k: int = 3) -> Column:
    """crc32 of the id written as text, modulo k (null id: fold of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % k


def bound_batches(spark: SparkSession) -> None:
    """Cap Arrow batches by bytes, so that very long texts can't swell one batch.

    Leaves a smaller limit set by the user alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    raw = str(spark.conf.get(key, "2147483647"))
    now = int(raw) if raw.isdigit() else 2 ** 31 - 1
    if now > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def chunks(texts, limit: int = 400_000):
    """Consecutive runs of texts of about ``limit`` characters (one text at least)."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


#: Blocks in which every code point has had its class for many Unicode versions.
_SETTLED = re.compile("[^\x00-՗‐-⁤ぁ-ゖァ-ヺ一-龥가-힣]")


@lru_cache(maxsize=8)
def splitter(pattern: str):
    return regex.compile(pattern)


@lru_cache(maxsize=8)
def ascii_splitter(pattern: str):
    """The pattern for texts of ASCII alone, in Python's own faster engine (None if it has other
    classes). With ``re.ASCII`` white space is what Unicode has below 128, so both find the same."""
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
    return None if r"\p" in plain else re.compile(plain, re.ASCII)


def unsettled(text: str) -> bool:
    """Whether a text holds a code point whose class may differ between the Unicode
    tables of the regex engines involved (those that Python's own table lacks)."""
    if text.isascii() or _SETTLED.search(text) is None:
        return False
    return any(unicodedata.category(c) == "Cn" for c in set(text))


@lru_cache(maxsize=1)
def _library_splitter():
    from tokenizers import pre_tokenizers
    return pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)


def pre_tokens(text: str, pattern: str) -> list[str]:
    """The matches of the byte-level pattern in a text, in order.

    Texts with code points newer than Python's Unicode table are split by the
    tokenizer library's own engine, so that both sides see the same classes."""
    if text.isascii() and (scan := ascii_splitter(pattern)) is not None:
        return scan.findall(text)
    if unsettled(text):
        return [text[a:b] for _, (a, b) in _library_splitter().pre_tokenize_str(text)]
    return splitter(pattern).findall(text)


class Generations:
    """A bounded memory in two generations: when the young one is full it becomes the old one, and
    what is asked for again moves to the young one, so frequent entries are never forgotten."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        """A remembered value, or None."""
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value
