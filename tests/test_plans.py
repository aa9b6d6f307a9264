"""The physical plans keep the properties that matter at scale."""

import re

import pytest

from slyglot.operators import labelers as L
from slyglot.operators import lexicon_join
from slyglot.plans import corpus
from slyglot.plans.queries import QUERIES


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q not in {"scan_labeled_csv", "scan_json_lexicons", "scan_lexicon_files"}))
def test_no_cross_join_and_narrow_scan(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "n_chars" not in plan


def test_labeler_is_narrow(spark, sf_dir):
    posts = corpus.table(spark, sf_dir, "documents")
    for phonetic in (False, True):
        plan = plan_of(L.label_evasion(posts.select("doc_id", "text"), phonetic=phonetic))
        assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


@pytest.mark.parametrize("phonetic", [False, True])
def test_words_are_computed_once(spark, sf_dir, phonetic):
    posts = corpus.table(spark, sf_dir, "documents").select("doc_id", "text")
    labeled = L.label_evasion(posts, phonetic=phonetic)
    # a filter on the result must not run the detectors a second time
    for frame in (labeled, labeled.filter("size(labels) > 0"), labeled.filter("labels[0] = 'homophone'")):
        plan = plan_of(frame)
        assert plan.count("regexp_extract_all") == 2
        assert plan.count("levenshtein(") == plan_of(labeled).count("levenshtein(")


def test_filter_on_other_columns_reaches_the_scan(spark, sf_dir):
    posts = corpus.table(spark, sf_dir, "documents").select("doc_id", "text")
    plan = plan_of(L.label_evasion(posts).filter("doc_id = 7"))
    assert "EqualTo(doc_id,7)" in plan


def test_hash_is_computed_once_per_image(spark, sf_dir):
    plan = plan_of(QUERIES["label_image_match"](spark, sf_dir))
    assert plan.count("zip_with(") <= 4


def built_sides(plan):
    """What each broadcast join of a plan builds: the scans and rows below its exchange."""
    lines = plan.split("\n")
    depth = lambda line: len(re.match(r"[ :+\-*|()\d]*", line).group())
    for at, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = []
            for under in lines[at + 1:]:
                if depth(under) <= depth(line):
                    break
                below.append(under)
            yield "\n".join(below)


@pytest.mark.parametrize("name,scans", [
    ("ts_words_join", 1), ("charsub_exact_join", 1), ("charsub_fuzzy_join", 1), ("homophone_phonetic_join", 1),
    ("label_citations_join", 2), ("search_top_k_join", 1), ("label_evasion_join", 2),
])
def test_lexicon_joins_never_build_the_texts(spark, sf_dir, name, scans):
    """Only lexicons and settled matches are built; the second step scans the texts once.

    Joining labels back to all posts reads the ids once more, without the texts.
    """
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert all("documents" not in side for side in built_sides(plan))
    found = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*documents", plan)
    assert len(found) == scans and sum("text" in columns for columns in found) == 1


def test_long_lexicons_join_by_shuffle(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(lexicon_join, "BROADCAST_ROWS", 0)
    plan = plan_of(QUERIES["charsub_exact_join"](spark, sf_dir))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_exploded_words_and_keys_are_computed_once(spark):
    """Spark asks of an exploded array whether it is empty; that must not compute it again."""
    from slyglot.lexicons import Lexicons
    from slyglot.operators import lexicon_join

    posts = spark.createDataFrame([(1, "kill them with death", ["kill", "them"])], "post_id long, text string, w array<string>")
    optimized = lambda frame: frame._jdf.queryExecution().optimizedPlan().toString()
    assert optimized(lexicon_join.post_tokens(posts, "w")).count("array_distinct(") == 1
    keys = lexicon_join.match_keys(posts, Lexicons())
    assert optimized(keys).count("concat_ws(") == 1
    some = lexicon_join.match_keys(posts, Lexicons(), kinds=("norm_context", "raw_strict"))
    assert "concat_ws(" not in optimized(some)
    wanted = keys.filter("kind IN ('norm_context', 'raw_strict')")
    assert sorted(some.collect()) == sorted(wanted.collect())
