"""The pipeline against brute-force versions of its stages."""
import base64
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import tiktoken

import corpus_pipeline
from paysight.llm import bpe, language, mixing, quality
from tests.llm.conftest import SF
from tests.llm.test_mixing import targets
from tests.llm.test_simhash import brute_components, brute_fp


def test_run_equals_the_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    score = {r.doc_id: r.score for r in quality.quality_scores(docs, docs, labels).collect()}
    kept = docs.where(docs.doc_id.isin([d for d, s in score.items() if s >= 0.5]))
    lang = {r.doc_id: r for r in language.languages(kept, kept).collect()}
    rows = [r for r in kept.collect() if lang[r.doc_id].lang_pred != "und" and lang[r.doc_id].score >= 0.5]
    roots = brute_components([brute_fp(r.text) for r in rows])
    first = {}
    for r, root in sorted(zip(rows, roots, strict=True), key=lambda x: x[0].doc_id):
        first.setdefault(root, r)
    rows = list(first.values())
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    total = Counter()
    for r in rows:
        total[r.source] += size[r.doc_id]
    want = targets(dict(total))
    with open(P.path(bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expect = Counter()
    for r in rows:
        rate = want[r.source] / total[r.source]
        u = int(hashlib.md5(f"{mixing.SEED}:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2 ** 52
        ids = enc.encode_ordinary(r.text)
        expect[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
               hashlib.sha256(r.text.encode()).hexdigest()] += int(rate) + (u < rate - int(rate))
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +expect and 0 < len(rows) < docs.count()


def test_stages_keep_the_columns(spark, edge_docs, no_docs, tmp_path):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
