"""Token counts and byte-level BPE against the libraries themselves."""
import base64
import hashlib
import unicodedata

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from paysight.llm import bpe, token_counts
from tests.llm.conftest import SF, edge_texts


def library_counts(texts):
    t = Tokenizer.from_file(P.path(token_counts.TOKENIZER))
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def tik():
    with open(P.path(bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_the_library(spark, edge_docs):
    rows = token_counts.token_counts(edge_docs, P.path(token_counts.TOKENIZER)).collect()
    texts = [r.text or "" for r in rows]
    assert [r.n_tokens for r in rows] == library_counts(texts)
    assert [r.n_bytes for r in rows] == [len(t.encode()) for t in texts]
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows) and rows[0]["a.b c"] is not Ellipsis


@pytest.mark.parametrize("table_size,cache_size", [(0, 262144), (50, 3), (0, 0)])
def test_counts_do_not_depend_on_the_tiers(spark, edge_docs, table_size, cache_size):
    rows = token_counts.token_counts(edge_docs, P.path(token_counts.TOKENIZER), table_size=table_size,
                                     cache_size=cache_size).collect()
    assert [r.n_tokens for r in rows] == library_counts([r.text or "" for r in rows])


def test_counts_of_the_query(spark):
    rows = token_counts.op1_token_counts(spark, SF).collect()
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert [r.n_tokens for r in rows] == library_counts([text[r.doc_id] for r in rows])
    assert len(rows) == len(text)


def test_empty_tables(spark, no_docs):
    assert token_counts.token_counts(no_docs, P.path(token_counts.TOKENIZER)).count() == 0
    assert bpe.token_digests(no_docs).count() == 0


def test_bpe_equals_the_library_and_round_trips(spark, edge_docs, tik):
    for r in bpe.encode_documents(edge_docs, P.path(bpe.RANKS)).collect():
        text = r.text or ""
        assert np.frombuffer(bytes(r.token_ids), "<u4").tolist() == tik.encode_ordinary(text), repr(text[:80])
        assert bytes(r.decoded) == text.encode() and r.n_tokens == len(r.token_ids) // 4


def test_bpe_query(spark, tik):
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = bpe.op5_byte_bpe(spark, SF).collect()
    assert len(rows) == len(text)
    for r in rows:
        ids = tik.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_small_leaves_give_the_same_tree(tik, monkeypatch):
    """Many joins: leaves of a few characters and bytes."""
    monkeypatch.setattr(bpe, "TEXT_LEAF", 5)
    monkeypatch.setattr(bpe, "PIECE_LEAF", 3)
    t = bpe.TreeBPE(bpe.tree_bpe(P.path(bpe.RANKS), P.PATTERN).ranks, P.PATTERN)
    for text in edge_texts():
        text = (text or "")[:3000]
        assert np.frombuffer(t.encode(text), "<u4").tolist() == tik.encode_ordinary(text), repr(text[:80])


def test_heap_merge_equals_plain_merge(monkeypatch):
    t = bpe.tree_bpe(P.path(bpe.RANKS), P.PATTERN)
    for text in edge_texts():
        data = (text or "").encode()[:200]
        if not data:
            continue
        heap = t._merge_heap(data)
        monkeypatch.setattr(bpe, "LONG", 10 ** 9)
        assert t.merge(data) == heap
        monkeypatch.undo()


def test_classes_agree_with_the_library_for_all_code_points():
    """Pre-tokens of texts around every code point, in one long text a block of 2,048."""
    from tokenizers import pre_tokenizers

    from paysight.llm.common import pre_tokens
    lib = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    for block in range(0, 0x110000, 2048):
        chars = [chr(c) for c in range(block, block + 2048) if unicodedata.category(chr(c)) != "Cs"]
        text = "".join(f"a {c}{c}a1 {c} {c}!" for c in chars)
        assert pre_tokens(text, P.PATTERN) == [text[x:y] for _, (x, y) in lib.pre_tokenize_str(text)], hex(block)


def test_encode_and_decode_as_columns(spark, edge_docs):
    path = P.path(bpe.RANKS)
    rows = edge_docs.select("text", bpe.encode(edge_docs.text, path).alias("ids"))
    rows = rows.withColumn("back", bpe.decode(rows.ids, path)).collect()
    assert all(bytes(r.back) == (r.text or "").encode() for r in rows)
    empty = spark.createDataFrame([(None,)], "ids binary")
    assert bytes(empty.select(bpe.decode(empty.ids, path).alias("b")).first().b) == b""
