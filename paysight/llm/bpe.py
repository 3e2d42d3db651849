"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is cut in halves down to leaves, the leaves are encoded on their own, and
neighbours are joined on the way up. Two joins are used, one above the other:

* Pre-tokens of a long text. The pattern scans from left to right without looking
  back, and a match depends only on its start and on two characters past its end.
  So of the left half all matches stand that end ``LOOK`` characters before the cut;
  from there the scan is run again across the cut, match by match (the window grows),
  until it meets a match boundary of the right half. From that point on both scans
  are the same, so all other matches of the right half stand.

* Tokens of a long pre-token. The merges of lowest rank first give a sequence in which
  every pair of neighbours encodes to itself, and a sequence with that property is the
  encoding. So the tokens within a window around the cut are encoded anew, and the
  window doubles until the pairs at its two ends encode to themselves: the tokens
  outside are then proven to stay.

Leaves are small (``TEXT_LEAF`` characters, ``PIECE_LEAF`` bytes), so that joins are no rare case
(README has the shares). A worker remembers the ids of pre-tokens, of halves and of pairs in
bounded memories.

Token ids are carried as packed little-endian unsigned 32-bit integers. Decoding maps
ids to bytes and concatenates up the same kind of tree.

Defined results: a null text encodes like the empty one (no ids, empty bytes); null ids
decode to empty bytes; repeated rows are encoded each; input columns with the names of
the results are replaced; an empty table gives an empty result; no text is cut short.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.llm.common import Generations, ascii_splitter, bound_batches, pre_tokens, splitter, table, text_or_empty, unsettled, unused

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters of a leaf of the text tree, bytes of a leaf of the pre-token tree.
TEXT_LEAF, PIECE_LEAF = 2_048, 12
#: Bytes from which on merges are taken from a heap.
LONG = 64
#: Ids of a leaf of the decoding tree.
ID_LEAF = 65_536
#: Characters before a cut in which the end of a match may still depend on what follows.
LOOK = 3
#: Pre-tokens (of at most MAX_KEPT characters) whose ids a worker remembers, in each of two generations.
CACHE_SIZE, MAX_KEPT = 196_608, 64
#: Leaves, and pairs of tokens, that a worker remembers in each of two generations.
LEAVES, PAIRS = 32_768, 32_768
#: Rank of a pair that does not merge.
NEVER = 1 << 60


class TreeBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.bytes_of[i] = b
        self.single = [ranks[bytes([i])] for i in range(256)]
        #: Two ids (20 bits the second) to the id they merge to, which is its rank.
        self.merged = {a << 20 | b: i for t, i in ranks.items() for k in range(1, len(t))
                       if (a := ranks.get(t[:k])) is not None and (b := ranks.get(t[k:])) is not None}
        self.kept, self.leaves, self.pairs = Generations(CACHE_SIZE), Generations(LEAVES), Generations(PAIRS)

    # -- tokens of one pre-token ------------------------------------------------
    def merge(self, data: bytes) -> list[int]:
        """Lowest rank first, leftmost among equals."""
        if len(data) > LONG:
            return self._merge_heap(data)
        ids, get = [self.single[b] for b in data], self.merged.get
        ranks = [get(a << 20 | b, NEVER) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) != NEVER:
            i = ranks.index(best)
            ids[i:i + 2] = [best]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 20 | best, NEVER)
            if i < len(ranks):
                ranks[i] = get(best << 20 | ids[i + 1], NEVER)
        return ids

    def _merge_heap(self, data: bytes) -> list[int]:
        """The same by a heap over a linked list, for windows that have grown long."""
        n, rank = len(data), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := rank(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := rank(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i:end[i]]])
            i = end[i]
        return out

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def stable(self, a: int, b: int) -> bool:
        """Whether two neighbouring tokens encode to themselves."""
        known = self.pairs.get(a << 20 | b)
        if known is None:
            known = self.merge(self._bytes([a, b])) == [a, b]
            self.pairs.put(a << 20 | b, known)
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        width = 2
        while True:
            a, c = max(0, len(left) - width), min(len(right), width)
            window = self.merge(self._bytes(left[a:] + right[:c]))
            if (a == 0 or self.stable(left[a - 1], window[0])) and (
                    c == len(right) or self.stable(window[-1], right[c])):
                return left[:a] + window + right[c:]
            width *= 2

    def tokens(self, data: bytes) -> list[int]:
        if len(data) <= PIECE_LEAF:
            return self.merge(data)
        mid = len(data) // 2
        return self.join(self._half(data[:mid]), self._half(data[mid:]))

    def _half(self, data: bytes) -> list[int]:
        ids = self.leaves.get(data)
        if ids is None:
            ids = self.tokens(data)
            if len(data) <= MAX_KEPT:
                self.leaves.put(data, ids)
        return ids

    def piece(self, text: str) -> bytes:
        """Packed ids of one pre-token; one that is a token itself is not merged."""
        data = text.encode("utf-8", "replace")
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else self.tokens(data)
        return struct.pack(f"<{len(ids)}I", *ids)

    # -- pre-tokens of one text -------------------------------------------------
    def pieces(self, text: str) -> list[str]:
        if len(text) <= TEXT_LEAF or unsettled(text):
            return pre_tokens(text, self.pattern)
        scan = ascii_splitter(self.pattern) if text.isascii() else None
        return self._halves(scan or splitter(self.pattern), text, 0, len(text))

    def _halves(self, scan, text: str, lo: int, hi: int) -> list[str]:
        if hi - lo <= TEXT_LEAF:
            return scan.findall(text, lo, hi)
        mid = (lo + hi) // 2
        left, right = self._halves(scan, text, lo, mid), self._halves(scan, text, mid, hi)
        at = mid
        while left and at > mid - LOOK:
            at -= len(left.pop())
        meets, taken = mid, 0  # the boundaries of the right half, one by one
        while at != meets:
            if at < meets:
                left.append(scan.match(text, at, hi)[0])
                at += len(left[-1])
            else:
                meets += len(right[taken])
                taken += 1
        left.extend(right[taken:] if taken else right)
        return left

    # -- both directions --------------------------------------------------------
    def encode(self, text: str) -> bytes:
        pieces = self.pieces(text)
        out = list(map(self.kept.young.get, pieces))
        if None in out:
            out = [self._ids(p) if x is None else x for x, p in zip(out, pieces, strict=True)]
        return b"".join(out)

    def _ids(self, p: str) -> bytes:
        ids = self.kept.get(p)
        if ids is None:
            ids = self.piece(p)
            if len(p) <= MAX_KEPT:
                self.kept.put(p, ids)
        return ids

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, dtype="<u4")
        if len(ids) <= ID_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        mid = len(ids) // 2 * 4
        return self.decode(packed[:mid]) + self.decode(packed[mid:])


@lru_cache(maxsize=2)
def tree_bpe(path: str, pattern: str) -> TreeBPE:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return TreeBPE(ranks, pattern)


def encode(text: Column, path: str, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Packed token ids (binary) of a text column."""
    @F.pandas_udf("binary")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = tree_bpe(path, pattern)
        for s in batches:
            yield pd.Series([bpe.encode(t) for t in s], dtype=object)
    return encoded(F.coalesce(text.cast("string"), F.lit("")))


def decode(ids: Column, path: str, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Bytes (binary) of packed token ids."""
    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = tree_bpe(path, pattern)
        for s in batches:
            yield pd.Series([bpe.decode(bytes(x)) for x in s], dtype=object)
    return decoded(F.coalesce(ids, F.lit(b"")))


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``token_ids`` (packed), ``n_tokens`` and ``decoded`` (the round trip's bytes)."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("struct<ids: binary, decoded: binary>")
    def round_trip(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        """Both directions in one worker: a second one would hold the vocabulary again."""
        bpe = tree_bpe(path, public_tokenizers.PATTERN)
        for s in batches:
            ids = [bpe.encode(t) for t in s]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object),
                                "decoded": pd.Series([bpe.decode(x) for x in ids], dtype=object)})
    name = unused(docs, "_coded")
    coded = docs.withColumn(name, round_trip(text_or_empty(text)))
    out = coded.withColumns({"token_ids": F.col(name)["ids"], "decoded": F.col(name)["decoded"]}).drop(name)
    return out.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the sha256 of the ids and of the decoded bytes."""
    coded = encode_documents(docs.select("doc_id", "text"), path or public_tokenizers.path(RANKS))
    return coded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
