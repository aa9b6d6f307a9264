"""The pipeline against its parts, and the registration of all queries."""

import corpus_pipeline
import pytest

import __spark_entry__
from slyglot.llm import decontaminate, piece_bpe, quality_gam, simhash_cover
from slyglot.llm.queries import QUERIES, tokenizer_file

from .helpers import awkward, empty


def test_one_query_for_each_operator():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and len(QUERIES) == 13 and len(corpus_pipeline.STAGES) == 5


def test_pipeline_equals_its_operators_applied_in_turn(spark, sf_dir):
    docs, labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    good = {r.doc_id for r in quality_gam.scores(docs, quality_gam.learn(docs, labels)).where("predicted = 1").collect()}
    left = docs.where(docs.doc_id.isin(sorted(good)))
    group = {}
    for r in simhash_cover.near_duplicates(left).collect():
        group.setdefault(r.component_id, []).append(r.doc_id)
    kept = {min(ids) for ids in group.values()}
    hit = {r.doc_id for r in decontaminate.contained_items(docs, benchmark).collect()}
    assert {r.doc_id for r in rows} == kept - hit and len(rows) == len(kept - hit) > 100
    assert hit & kept
    model = piece_bpe.PieceCodec(tokenizer_file())
    assert not any("@mail" in model.decode(r.ids) for r in rows)


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_and_take_awkward_rows(spark, sf_dir, stage):
    for docs in (awkward(spark), empty(spark)):
        assert corpus_pipeline.STAGES[stage][1](spark, docs, sf_dir).columns == docs.columns
        corpus_pipeline.STAGES[stage][1](spark, docs, sf_dir).collect()
