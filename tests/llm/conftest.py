import random

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

CLASHES = ("_found", "_source", "_size", "_copies", "_row", "row", "fp", "_keep", "digest", "score", "size", "label", "h")

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use for their own results, and odd ones
    T.StructField("n_tokens", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("a.b c", T.StringType()),
    *(T.StructField(c, T.StringType()) for c in CLASHES)])


def edge_texts():
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "don't", "naïve", "straße", "42", "x1y2", "WE'LL", "日本語", "ñandú"]
    long_prose = " ".join(rng.choice(words) for _ in range(9000))
    return [None, "", " ", "\n\n\n", "a", "word", "two words", "<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|>",
            "it's we'll I'd they've 'tis 'r 're", "tabs\tand spaces  \n\n  mixed   ", "🙂🙂 emoji\U0001F9D1‍\U0001F680 ź",
            "new letters \U0001e6ff ᲉꟜ \U0001fae9 end", "a" * 5000, " " * 3001 + "x", "ab" * 3000 + "!" * 999,
            long_prose, "0123456789" * 700, "\x00\x1c\x1f\x85 control", "x y　z", "İstanbul ſ K",
            *("".join(rng.choice("abcde '.\n\t1") for _ in range(rng.randint(1, 400))) for _ in range(40))]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], ["s0", "s1", None, "S2"][i % 4], None if t is None else len(t), "t", "s", "o")
            for i, t in enumerate(edge_texts())]
    rows += [rows[5], rows[5], (900, "word", "en", "s0", 4, None, None, None), (None, "no id", None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame([(*r, *("c" for _ in CLASHES)) for r in rows], DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
