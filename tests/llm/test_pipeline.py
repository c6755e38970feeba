"""Registered queries against their SQL, and the pipeline's stages against SQL and plain Python."""

from __future__ import annotations

import os
import re

import brute
import numpy as np
import public_tokenizers
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from factorloom.llm import bpe, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name]) is None


def test_all_registered():
    names = entry.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_whole_table(spark, name):
    got = queries.QUERIES[name](spark, SF)
    n = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "pages")}
    rows = {"op4_bpe_codec": n["documents"], "op7_html_text": n["pages"], "op8_sharding": n["documents"], "op9_jaccard_join": n["documents"], "op11_source_mix": n["documents"]}
    assert got.count() == rows.get(name, got.count()) > 0


def test_packed_rows_hold_the_ids(spark):
    """The registered query's rows, taken apart, are the ids of every whole text."""
    from factorloom.llm import packing

    packed = queries.packed_rows(spark, SF)
    got = {r.doc_id: bytes(r.ids) for r in packing.unpack(packed).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    coded = bpe.encode(docs, public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN).collect()
    assert got == {r.doc_id: bytes(r.ids) for r in coded if r.n_tokens}
    assert all(len(r.ids) == 4 * 8192 and r.cu_seqlens[-1] == r.n_tokens for r in packed.collect())


def test_mix_meets_its_targets(spark):
    out = queries.source_mix(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").toPandas()
    sums = out.merge(docs, on="doc_id").groupby("source").agg({"taken": "sum", "target": "first", "size": "sum", "source_size": "first"})
    assert ((sums.taken - sums.target).abs() <= 0.01 * sums.target + 1).all() and (sums["size"] == sums.source_size).all()
    assert (out.taken <= 2 * out["size"]).all()


def test_stages(spark):
    con = connect(SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(pipeline.STAGES)

    def step(name):
        out = stages[name](spark, docs, SF)
        assert out.columns == columns
        return spark.createDataFrame(out.collect(), docs.schema)

    kept = {r[0] for r in con.execute(queries.SQL["op2_quality_rules"]).fetchall() if r[-1]}
    docs = step("quality_rules")
    assert {r.doc_id for r in docs.collect()} == kept

    before = sorted((r.doc_id, r.text) for r in docs.collect())
    docs = step("line_dedup")
    cut = {d: t for (d, _), t in zip(before, brute.kept_lines(before, 50)) if brute.WORD.search(t)}
    assert {r.doc_id: r.text for r in docs.collect()} == cut and all(r.n_chars == len(r.text) for r in docs.collect())

    before = [(r.doc_id, r.text) for r in docs.collect()]
    docs = step("near_duplicates")
    assert {r.doc_id for r in docs.collect()} == {d for d, _, c in brute.components(before, 5, 80) if d == c}

    left = docs.toPandas()
    con.execute("DROP VIEW documents")
    con.register("documents", left)
    leaked = {r[0] for r in con.execute(queries.SQL["op6_decontamination"]).fetchall()}
    docs = step("benchmark_decontamination")
    assert leaked and {r.doc_id for r in docs.collect()} == set(left["doc_id"]) - leaked

    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path(queries.RANKS))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = {r.doc_id: (np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in stages["bpe_encoding"](spark, docs, SF).collect()}
    assert coded == {r.doc_id: (encoding.encode_ordinary(r.text), r.text.encode()) for r in docs.collect()}


def test_stages_on_odd_rows(spark, odd, none):
    text = " ".join(f"clean{i}" for i in range(40))
    extra = odd.limit(1).withColumns({"doc_id": F.lit(99).cast("long"), "text": F.lit(text)})
    for docs in (none, odd.unionByName(extra)):
        columns = docs.columns
        for name, stage in pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert name == "bpe_encoding" or docs.columns == columns
        ids = [r.doc_id for r in docs.collect()]
    assert sorted(ids) == [4, 99]


def test_nothing_else_imports_the_package():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(os.path.join(root, "factorloom")):
        for f in files:
            if f.endswith(".py") and os.path.basename(folder) != "llm":
                assert not re.search(r"\bllm\b", open(os.path.join(folder, f)).read()), f
