"""Sources and sinks: CSV null spellings and types, missing reports, model I/O."""

import os
import tempfile

from pyspark.sql import types as T

from paysight.sources import files as FS


def test_s1_csv_null_tokens_and_types(spark):
    d = tempfile.mkdtemp(prefix="paysight-csv-")
    p = os.path.join(d, "in.csv")
    with open(p, "w") as f:
        f.write('id,salary,skills\n1,100.5,"[\'a\', \'b\']"\n2,NaN,N/A\n3,bad,""\n')
    schema = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("salary", T.DoubleType()),
                           T.StructField("skills", T.StringType())])
    got = sorted(FS.read_csv(spark, p, schema).collect())
    assert got[0]["salary"] == 100.5 and got[0]["skills"] == "['a', 'b']"
    assert got[1]["salary"] is None and got[1]["skills"] is None
    assert got[2]["salary"] is None and got[2]["skills"] is None


def test_v11_missing_report_is_empty(spark):
    d = tempfile.mkdtemp(prefix="paysight-rep-")
    schema = T.StructType([T.StructField("model", T.StringType()),
                           T.StructField("RMSE", T.DoubleType())])
    present = os.path.join(d, "cmp")
    FS.write_json(spark.createDataFrame([("a", 1.0)], schema), present)
    out = FS.load_reports(spark, {"cmp": present, "cv": os.path.join(d, "missing")}, schema)
    assert [(r["report"], r["model"]) for r in out.collect()] == [("cmp", "a")]
