"""Components: the result by breadth-first search, and how many tables are stored on the way."""

import random

import pytest

from brickyard.llm import common, ngram_join


def reached(links):
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        todo = [start] if start not in out else []
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += near[x]
    return out


@pytest.fixture
def stored(monkeypatch):
    tables = []
    written = common.written
    monkeypatch.setattr(common, "written", lambda df, *a: tables.append(1) or written(df, *a))
    return tables


def chance(n, m):
    draw = random.Random(n * m)
    return [(draw.randrange(n), draw.randrange(n)) for _ in range(m)]


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(100)], [(7 * i % 101, 7 * (i + 1) % 101) for i in range(100)], [(0, i) for i in range(1, 60)] + [(99, i) for i in range(1, 60)],
    [(-5, 3), (3, -5), (3, 9), (2, 4)], chance(300, 200), chance(200, 400)], ids=["chain", "shuffled chain", "two hubs", "doubled", "sparse", "dense"])
def test_components(spark, links):
    got = common.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = reached([x for x in links if x[0] != x[1]])
    assert {r["id"]: r["component_id"] for r in got} == want and len(got) == len(want)


def test_stars_are_found_at_once(spark, stored):
    links = [(h, 10 * h + i) for h in (3, 100, 2000) for i in range(1, 9)]
    got = common.components(spark.createDataFrame(links, "a long, b long"))
    assert {r["id"]: r["component_id"] for r in got.collect()} == reached(links)
    assert len(stored) == 2
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_are_not_computed_anew_without_new_links(spark, monkeypatch):
    """Two groups with one passage in common, long enough for a shared signature: the pair across them fails, and nothing is left to join."""
    calls = []
    components = ngram_join.components
    monkeypatch.setattr(ngram_join, "components", lambda *a: calls.append(1) or components(*a))
    own = [" ".join(f"g{g}w{i}" for i in range(16)) for g in range(2)]
    shared = " ".join(f"s{i}" for i in range(190))
    rows = [(10 * g + i, f"{shared} {own[g]} tail{i}") for g in range(2) for i in range(4)]
    got = ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {d: d // 10 * 10 for d, _ in rows}
    assert len(calls) == 1
