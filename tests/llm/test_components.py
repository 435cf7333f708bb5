"""How many rounds connected components take."""

import pytest

from tidemark.llm import components as module
from tidemark.sources.store import Scratch


@pytest.fixture
def stored(monkeypatch):
    names = []

    class Counting(Scratch):
        def __call__(self, df, name):
            names.append(name)
            return super().__call__(df, name)

    monkeypatch.setattr(module, "Scratch", Counting)
    return names


def found(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    return {r.node: r.component for r in module.components(df).collect()}


def test_stars_take_no_round(spark, stored):
    edges = [(1, 2), (3, 1), (4, 5), (1, 2), (7, 7), (None, 1), (8, None)]
    assert found(spark, edges) == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    assert stored == ["edges"]


def test_a_round_that_ends_in_stars_is_the_last(spark, stored):
    assert found(spark, [(1, 3), (2, 3), (3, 4)]) == {1: 1, 2: 1, 3: 1, 4: 1}
    assert stored.count("small") == 1


def test_a_long_path_is_one_component(spark, stored):
    assert set(found(spark, [(i, i + 1) for i in range(40)]).values()) == {0}
    assert stored.count("small") <= 6
