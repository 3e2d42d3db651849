"""Token counts by a map-side two-tier lookup.

Tier 1 is a compact table ``pre-token -> number of tokens`` of the most frequent
pre-tokens of the corpus, broadcast to every worker (bounded by ``table_size``).
Tier 2 is a cache in each Python worker, bounded by ``cache_size``: a pre-token
that tier 1 lacks is encoded by the tokenizer library once per worker and then
remembered. No pre-token is ever shuffled; the only exchange is of the bounded
per-task summaries from which the frequent pre-tokens are chosen.

The table is only a shortcut: counts are the same with any table, or none.

Defined results: a null text counts as the empty one (0 bytes, 0 tokens); rows keep
their multiplicity (repeated rows give repeated results); other columns of the input,
whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.llm.common import Generations, bound_batches, chunks, pre_tokens, table, text_or_empty

#: Entries of the broadcast table (tier 1).
TABLE_SIZE = 32_768
#: Pre-tokens that a worker remembers besides (tier 2), in two generations: entries that are asked for again stay.
CACHE_SIZE = 524_288
#: Pre-tokens that one task reports when the frequent ones are chosen.
SUMMARY_SIZE = 16_384
#: Longer pre-tokens are encoded each time and never kept.
MAX_KEPT_CHARS = 64
LIMIT = 512
TOKENIZER = "byte_bpe_50k.json"


class Tokenizer:
    """The library's tokenizer, with its pre-tokens counted one by one."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer as Library
        self.library = Library.from_file(path)
        kind = type(self.library.pre_tokenizer).__name__
        added = list(self.library.get_added_tokens_decoder().values())
        if kind != "ByteLevel" or self.library.normalizer is not None or any(
                a.lstrip or a.rstrip or a.single_word for a in added):
            raise ValueError("a byte-level tokenizer without normalizer is expected")
        names = sorted((a.content for a in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many added tokens stand in it."""
        if self.special is None or self.special.search(text) is None:
            return pre_tokens(text, public_tokenizers.PATTERN), 0
        parts = self.special.split(text)
        return [p for x in parts if x for p in pre_tokens(x, public_tokenizers.PATTERN)], len(parts) - 1

    def lengths(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch(pieces, add_special_tokens=False)]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


class Lookup:
    """Both tiers: the table's entries stay, the others are held in two generations."""

    def __init__(self, frequent: dict[str, int], path: str, cache_size: int):
        self.tok, self.cache = tokenizer(path), Generations(max(1, cache_size // 2))
        self.frequent = frequent

    def counts(self, texts: list[str]) -> list[int]:
        split = [self.tok.pieces(t) for t in texts]
        frequent, cached = self.frequent, self.cache.get
        known, missing = {}, []
        for p in set().union(*(p for p, _ in split)):
            n = frequent.get(p)
            if n is None:
                n = cached(p)
            if n is None:
                missing.append(p)
            else:
                known[p] = n
        for p, n in zip(missing, self.tok.lengths(missing) if missing else (), strict=True):
            known[p] = n
            if len(p) <= MAX_KEPT_CHARS:
                self.cache.put(p, n)
        get = known.__getitem__
        return [s + sum(map(get, x)) for x, s in split]


def frequent_pre_tokens(docs: DataFrame, text: str = "text", table_size: int = TABLE_SIZE,
                        summary_size: int = SUMMARY_SIZE) -> list[str]:
    """The most frequent pre-tokens over all rows, by bounded per-task summaries.

    Words between spaces stand for the pre-tokens here (a word after a space is one where it has
    only letters), which takes a tenth of the time of the pattern; the table is only a shortcut,
    and the pre-tokens it lacks are few and soon in the worker's cache.
    Each task counts its own words and keeps the ``summary_size`` largest counts
    whenever it holds four times as many, so memory and the rows exchanged are bounded
    per task; the summaries are added up and the ``table_size`` largest come to the driver."""
    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for run in chunks(pdf["t"]):
                for t in run:
                    seen.update(t.split(" "))
                if len(seen) > 4 * summary_size:
                    seen = Counter(dict(seen.most_common(summary_size)))
        top = [(f" {w}", n) for w, n in seen.most_common(summary_size) if n > 1 and w.isalpha() and len(w) < MAX_KEPT_CHARS]
        yield pd.DataFrame(top, columns=["p", "n"])

    found = (docs.select(text_or_empty(text).alias("t")).mapInPandas(summary, "p string, n long")
             .groupBy("p").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "p").limit(table_size))
    return [r.p for r in found.collect()]


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT,
                 table_size: int = TABLE_SIZE, cache_size: int = CACHE_SIZE) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` to each row.

    Columns of the input with these names are replaced."""
    spark = docs.sparkSession
    bound_batches(spark)
    pieces = frequent_pre_tokens(docs, text, table_size) if table_size else []
    lengths = tokenizer(path).lengths(pieces) if pieces else []
    frequent = spark.sparkContext.broadcast(dict(zip(pieces, lengths, strict=True)))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lookup = Lookup(frequent.value, path, cache_size)
        for s in batches:
            yield pd.Series([n for run in chunks(s) for n in lookup.counts(run)], dtype="int64")

    body = text_or_empty(text)
    return (docs.withColumn("n_tokens", count(body))
            .withColumn("n_bytes", F.octet_length(body).cast("long"))
            .withColumn("over_limit", F.col("n_tokens") > limit))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (token_counts(docs, public_tokenizers.path(TOKENIZER))
            .select("doc_id", "n_bytes", "n_tokens", "over_limit"))
