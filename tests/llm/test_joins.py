"""What the corpus operators broadcast, where Spark takes a table for smaller than it is."""

import corpus_pipeline
import pytest

from opsight.llm import simhash
from tests.conftest import plan_of


@pytest.fixture
def linked(monkeypatch):
    """The plans of the links that are asked for from now on."""
    plans, links = [], simhash.links

    def seen(*args, **kwargs):
        made = links(*args, **kwargs)
        plans.append(plan_of(made))
        return made

    monkeypatch.setattr(simhash, "links", seen)
    return plans


def _texts(spark):
    return spark.createDataFrame([(i, f"text {i % 3} of some words", "en", "x", 24) for i in range(9)],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def test_anchors_are_not_broadcast(spark, linked):
    # dozens of anchors a fingerprint, which Spark takes for one
    assert simhash.near_duplicates(_texts(spark)).count() == 9
    assert len(linked) == 1 and "SortMergeJoin" in linked[0] and "Broadcast" not in linked[0]


def test_pipeline_does_not_broadcast_anchors(spark, linked):
    kept = corpus_pipeline.near_duplicates(spark, _texts(spark), "")
    assert [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == [0, 1, 2]
    assert len(linked) == 1 and "SortMergeJoin" in linked[0] and "Broadcast" not in linked[0]
