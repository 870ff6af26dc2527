"""Operators that return documents pass columns of any name on, and the stages of the pipeline take any rows."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wardbook.llm import cotraining, jaccard, lines, mixing

SMALL = "/root/testdata/sf0.001"
FOLDER = Path(cotraining.__file__).parent
NAMES = sorted(
    {n for m in ("lines", "jaccard", "mixing", "cotraining", "common") for n in re.findall(r'"(_\w+)"', (FOLDER / f"{m}.py").read_text())}
    | {"key", "seq", "row", "place", "component", "number", "block", "start", "words", "times", "n", "id", "o", "size", "a.b", "With space"}
)


@pytest.fixture(scope="module")
def named(spark, edges):
    """Documents with a column for every name that the operators use inside, its value made of the name and the id."""
    plain = edges.select("doc_id", "text", "lang", "source", "n_chars")
    small = plain.filter("text is null or length(text) < 30000")
    return small.select("*", *[F.concat_ws(":", F.lit(n), "doc_id").alias(n) for n in NAMES])


def stages(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    return {
        "keep_good": lambda docs: cotraining.keep_good(docs, labels),
        "dedup_lines": lines.dedup_lines,
        "one_of_each": jaccard.one_of_each,
        "mixture": mixing.mixture,
    }


@pytest.mark.parametrize("name", ["keep_good", "dedup_lines", "one_of_each", "mixture"])
def test_columns_of_any_name_keep_their_values(spark, named, name):
    assert "_cut" in NAMES and len(NAMES) > 30
    found = stages(spark)[name](named)
    assert found.columns == named.columns
    assert [t for n, t in found.dtypes if n in NAMES] == ["string"] * len(NAMES)
    rows = found.collect()
    assert len(rows) > 5
    for r in rows:
        for n in NAMES:
            assert r[n] == (n if r["doc_id"] is None else f"{n}:{r['doc_id']}")


def test_pipeline_stages_take_any_rows(spark, named, nothing, tmp_path):
    """Nulls, empty texts, repeated rows and clashing names in, the same columns out, all the way down; nothing stays nothing."""
    docs = named
    texts = {r["text"] for r in named.select("text").collect()}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, SMALL)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
            docs.write.parquet(f"{tmp_path}/{i}")
            docs = spark.read.parquet(f"{tmp_path}/{i}")
            assert 0 < docs.count() <= 2 * before.count()
    rows = docs.collect()
    assert rows and all(r["n_tokens"] == len(r["ids"]) > 0 for r in rows)
    assert None in texts and "" in texts
    empty = nothing
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
        assert empty.count() == 0
