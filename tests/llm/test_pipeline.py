"""The pipeline's stages, each on the rows of the stage before it."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as contract
from fixtures import awkward, table, prose
from skyledger.llm.common import table as given
from skyledger.llm.common import written
from skyledger.llm.decontaminate import contamination, is_contaminated
from skyledger.llm.quality_rules import quality_verdicts
from skyledger.llm.simhash import simhash_groups
from test_scans import secret_base

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect())


def test_stages(spark):
    docs = given(spark, SF, "documents")
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        outputs.append(docs)
    first, clean, bare, scanned, packed = outputs
    source = given(spark, SF, "documents")
    for df in (first, clean, bare, scanned):
        assert df.dtypes == source.dtypes

    kept = {r.doc_id for r in quality_verdicts(source).filter("kept").collect()}
    before = {r.doc_id: r for r in source.collect()}
    assert rows_of(first) == Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for i, r in before.items() if i in kept)

    groups = simhash_groups(first).collect()
    heads = {r.component_id for r in groups}
    assert {r.doc_id for r in clean.collect()} == heads and clean.count() == len(heads) < len(groups)

    found = contamination(clean, given(spark, SF, "benchmark")).withColumn("bad", is_contaminated())
    bad = {r.doc_id for r in found.filter("bad").collect()}
    hit = {r.doc_id for r in found.filter("n_hit > 0").collect()}
    assert bad and {r.doc_id for r in bare.collect()} == heads - bad
    for r in bare.collect():
        assert (r.text == before[r.doc_id].text) == (r.doc_id not in hit)
        assert r.n_chars == len(r.text)

    texts = {r.doc_id: r.text for r in bare.collect()}
    assert {r.doc_id for r in scanned.collect()} == set(texts)
    for r in scanned.collect():
        if not secret_base(texts[r.doc_id]):
            assert r.text == texts[r.doc_id] or "[SECRET]" in r.text
        else:
            assert "[SECRET]" in r.text and not secret_base(r.text)

    tokens = packed.groupBy("doc_id").agg(F.sum("length").alias("n"))
    assert {r.doc_id for r in tokens.collect()} == set(texts)
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n"), F.count("*")).first()
    total = packed.agg(F.sum("length")).first()[0]
    assert full[0] <= 4096 and full[1] <= 1 + 1.05 * total / 4096


def test_stages_of_awkward_and_empty_tables(spark):
    for docs in (table(spark, awkward()), table(spark, awkward()).filter(F.lit(False))):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF), f"awkward-{name}")
        assert (docs.count() > 0) == (n > 0)


def test_every_operator_is_registered():
    names = [k for k in contract.queries() if re.match(r"op\d+_|pipeline$", k)]
    assert sorted(int(k[2:].split("_")[0]) for k in names if k != "pipeline") == list(range(1, 11))
    assert "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5


def test_copies_on_two_hosts_are_judged_by_host(spark):
    """One id and text under a good and a rejected host: the stage keeps what the verdict keeps."""
    from skyledger.llm.quality_rules import drop_low_quality, quality_verdicts

    good = prose(80, 61)
    rows = [(i, "short", "bad") for i in range(40)] + [(100 + i, prose(60, 70 + i), "good") for i in range(40)]
    rows += [(7777, good, "bad"), (7777, good, "good"), (None, good, "bad"), (None, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = quality_verdicts(docs).filter("kept").count()
    left = drop_low_quality(docs)
    assert left.count() == kept == 42
    assert sorted((str(r.doc_id), str(r.source)) for r in left.filter(F.col("text") == good).collect()) == [
        ("7777", "good"), ("None", "None")
    ]
