"""How many rows the near-copy stage and the mixture make or move, beside their results."""

from collections import Counter

import numpy as np
import pytest

from brickyard.llm import mixing, ngram_join
from tests.llm.test_operators import components_by_force


def edited(copies, words=300):
    """Copies of one text, each with its own share of other words, so that some are similar to none."""
    random = np.random.default_rng(2)
    base = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(copies):
        text = list(base)
        for j in random.choice(words, 2 + i * 14 // copies, replace=False).tolist():
            text[j] = f"x{i}y{j}"
        rows.append((i, " ".join(text)))
    return rows


def test_pairs_that_share_many_signatures_are_listed_few_times(spark, monkeypatch):
    rows, made = edited(60), []
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    join = type(frame).join

    def counted(self, other, *args):
        out = join(self, other, *args)
        if "label_a" in self.columns and "label_b" in other.columns:
            made.append(out.select("a", "b").count() / max(1, out.select("a", "b").distinct().count()))
        return out

    monkeypatch.setattr(type(frame), "join", counted)
    got = ngram_join.join_components(frame, 5, 80).select("doc_id", "n_shingles", "component_id").collect()
    want = components_by_force(rows, 5, 80)
    assert Counter(map(tuple, got)) == want and 5 < len({c for _, _, c in want}) < 60
    assert made and max(made) < 8


def test_families_hold_every_pair_of_a_signature(spark):
    random = np.random.default_rng(7)
    classes, rows = random.integers(-2**63, 2**63, 40).tolist(), []
    for sign in range(60):
        own = sorted(random.choice(classes[:12] if sign % 2 else classes, int(random.integers(3, 9)), replace=False).tolist())
        rows += [(sign, c, classes.index(c) % 5, len(own), own[0]) for c in own]
    got = ngram_join.families(spark.createDataFrame(rows, "sign long, class long, label long, n long, least long")).collect()
    held = {}
    for r in got:
        held.setdefault(r["family"], set()).add((r["class"], r["label"]))
    signs = {}
    for sign, c, label, *_ in rows:
        signs.setdefault(sign, set()).add((c, label))
    assert all(any(s <= f for f in held.values()) for s in signs.values())
    assert sum(len(f) ** 2 for f in held.values()) < sum(len(s) ** 2 for s in signs.values()) and len(got) == sum(map(len, held.values()))


def test_the_mixture_moves_no_texts(spark, docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mixing.take(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("sent", [0, 1 << 16])
def test_repeated_rows_are_taken_in_part(spark, monkeypatch, sent):
    monkeypatch.setattr(mixing, "SENT", sent)
    rows = [(i // 7, f"word{i // 7} and more", None if i % 2 and i // 7 == 3 else f"s{i // 7 % 3}") for i in range(70)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    want = Counter()
    for r in mixing.mix_sources(frame).collect():
        want[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixing.take(frame).collect()) == +want
