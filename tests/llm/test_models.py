"""Trained operators, vectors and archives."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brickyard.llm import bpe, cap_filters, fixity, language_id, pii, suffix_tree
from brickyard.llm.queries import tokenizer_path


def test_language_id(docs, odd, none):
    model = language_id.fit(docs)
    found = language_id.predict(docs, model).select("*", language_id.held_out().alias("held_out")).collect()
    right = [r["lang_pred"] == r["lang"] for r in found if r["held_out"]]
    assert sum(right) >= 0.97 * len(right) and all(0 <= r["score"] <= 1 for r in found)
    assert sum(not r["accepted"] for r in found) <= 2
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    rows = language_id.predict(odd, model).collect()
    letter = lambda t: bool(t and language_id.LETTER.search(t))
    assert len(rows) == odd.count() and all((r["lang_pred"] == "und") == (not letter(r["text"])) for r in rows)
    assert language_id.predict(none).count() == 0
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.lit(1).cast("long"))
    again = language_id.predict(other, model).select("text", "lang_pred", "score").collect()
    assert Counter((r["text"], r["lang_pred"], r["score"]) for r in again) == Counter((r["text"], r["lang_pred"], r["score"]) for r in found)


def base_by_patterns(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c in "0123456789"]
        double = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(double) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return out


@pytest.mark.parametrize("text", ["a@b@c.d e@f.g.h", "x.@y-z.1.", "1.2.3.4.5.6.7.8", "0255.01.1.1 256.1.1.1", "+1 (269) 555-1234 4111 1111-1111 1111", "@", "é@a.b 😀 1.1.1.1",
                                  "a..b@@c.d.e@f", "4111111111111111" * 3, "+1+22.333(444)5556", "1" * 40 + ".2.3.4"])
def test_base_patterns(text):
    assert pii.base_spans(text) == base_by_patterns(text)


def test_personal_data(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tagger = pii.fit(docs)
    rows = pii.find(docs, tagger).collect()
    kinds = Counter()
    for r in rows:
        base, spans = [tuple(s) for s in r["base"]], [tuple(s) for s in r["spans"]]
        assert base == base_by_patterns(r["text"] or "") and set(base) <= set(spans)
        kinds.update(s[0] for s in base)
        assert not [s for s in spans if s not in base and not pii.holds(s[0], r["text"][s[1]:s[2]])]
    assert set(kinds) == set(pii.KINDS)
    texts = ["call (602) 555-9039 now", "mail dikcoc.41(at)mail7.example.com ok", "ip 10[.]20[.]30[.]40 here", "mail dikcoc41 at mail7.example.com ok", "nothing at all", None, "", "7" * 700, "password=da6a7d4f67f2203943 v3.1"]
    added = [{s[0] for s in spans} for _, spans in pii.find_all(tagger, texts)]
    assert sum(a == {k} for a, k in zip(added, ("phone", "email", "ip", "email"), strict=False)) >= 3 and added[4:] == [set()] * 5, added
    assert pii.find_digests(odd, tagger).count() == odd.count() and pii.find_digests(none).count() == 0


def test_held_out_tags(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r["text"] for r in docs.collect() if pii.base_spans(r["text"] or "")]
    tagger = pii.train(texts[::2])
    codes, tags = pii.examples(texts[1::2], np.random.default_rng(0))
    found = np.array(pii.tag(tagger, list(codes)))
    assert (found == tags)[tags > 0].mean() > 0.9 and (found[tags == 0] > 0).mean() < 0.02


def test_many_copies_of_one_text_change_no_added_span(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    copies = spark.range(5000).select((F.col("id") + 10**6).alias("doc_id"), F.lit("only numbers 12 and 34 and no span").alias("text"))
    a, b = pii.fit(docs), pii.fit(docs.unionByName(copies))
    text = "call (602) 555-9039 or mail x.y(at)host.example.com, ip 10[.]20[.]30[.]40"
    assert b is not None and pii.find_all(a, [text]) == pii.find_all(b, [text])


def test_likelihood_and_best_tags_against_enumeration():
    random = np.random.default_rng(3)
    tagger = pii.new_tagger(2)
    tagger.p["t"] = random.normal(0, 1, (pii.TAGS, pii.TAGS)).astype(np.float32)
    codes = random.integers(0, pii.SYMBOLS, (3, 5))
    z = pii.emissions(tagger, codes) * 3
    paths = np.array(list(itertools.product(range(pii.TAGS), repeat=5)))
    for row in range(3):
        score = z[row][np.arange(5), paths].sum(axis=1) + tagger.p["t"][paths[:, :-1], paths[:, 1:]].sum(axis=1)
        assert pii.viterbi(z[row:row + 1], np.array([5]), tagger.p["t"])[0].tolist() == paths[score.argmax()].tolist()
    z = pii.emissions(tagger, codes)
    tags = random.integers(0, pii.TAGS, (3, 5))
    want = 0.0
    for row in range(3):
        score = (z[row][np.arange(5), paths].sum(axis=1) + tagger.p["t"][paths[:, :-1], paths[:, 1:]].sum(axis=1)).astype(float)
        own = z[row][np.arange(5), tags[row]].sum() + tagger.p["t"][tags[row, :-1], tags[row, 1:]].sum()
        want += (np.log(np.exp(score - score.max()).sum()) + score.max() - own) / 3
    assert pii.gradient(tagger, codes, tags)[0] == pytest.approx(want, rel=1e-4)


def test_gradient_of_the_tagger():
    random = np.random.default_rng(0)
    tagger = pii.new_tagger(1)
    codes, tags = random.integers(0, pii.SYMBOLS, (2, 7)), random.integers(0, pii.TAGS, (2, 7))
    _, g = pii.gradient(tagger, codes, tags)
    for name, place in (("t", (1, 2)), ("wo", (3, 1)), ("wf", (2, 5)), ("wb", (14, 8)), ("e", (int(codes[0, 0]), 1))):
        values = []
        for step in (0.01, -0.01):
            tagger.p[name][place] += step
            values.append(pii.gradient(tagger, codes, tags)[0])
            tagger.p[name][place] -= step
        assert (values[0] - values[1]) / 0.02 == pytest.approx(g[name][place], abs=2e-3)


def words_of(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low)), None]


@pytest.mark.parametrize("name", ["docs", "odd"])
def test_base_scores(request, name):
    table = request.getfixturevalue(name)
    docs = [(r["doc_id"], words_of(r["text"])) for r in table.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, ws in docs if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4)) for i, ws in docs)
    rows = suffix_tree.score(table).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows) == want
    if name == "docs":
        assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["base_score"] for r in rows if r["held_out"])


def test_states_sum_to_one(docs, none):
    texts = docs.select("text")
    counts = suffix_tree.count_keys(texts, lambda hashes, offsets: hashes).cache()
    tree = suffix_tree.grow(texts, counts, texts.count())
    assert [len(s["contexts"]) for s in tree.states][0] > 3
    k, c = suffix_tree.arrow_columns(counts)
    base, now = 10.0 ** tree.base(c.astype(float)), suffix_tree.find(tree.words, k)
    unknown = 0.1 / (tree.total + 0.1 * (tree.distinct + 1))
    assert base.sum() + unknown == pytest.approx(1)
    for depth, state in enumerate(tree.states):
        for code in state["contexts"][:5]:
            before, second = (code, -1) if depth == 0 else (code % tree.wide, code // tree.wide)
            ones = np.ones(len(k) + 1, np.int64)
            p = np.append(base, unknown) * 10.0 ** suffix_tree.change(tree, np.append(now, -1), ones * before, ones * second)
            assert p.sum() == pytest.approx(1, abs=1e-6)
    assert suffix_tree.score(none).count() == 0


def test_cap_filters_against_all_pairs(spark):
    random = np.random.default_rng(2)
    x = random.normal(size=(1500, 32)).astype(np.float32)
    for i in range(300):
        x[i] = x[1000 + i % 40] + random.normal(size=32) * 0.12
    x[300:310] = x[299]
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(len(x))]
    rows += [(2000, None, 0), (2001, [], 0), (2002, [0.0] * 32, 0), (2003, [float("nan")] * 32, 0), (2004, [None, *[1.0] * 31], 0), (None, [float(v) for v in x[0]], 0), (2005, [1.0, 2.0], 1), (2006, [2.0, 4.0], 1)]
    got = cap_filters.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)).collect()
    assert len(got) == len(rows)
    d = np.vstack([x, x[:1]]).astype(float)
    d /= np.linalg.norm(d, axis=1)[:, None]
    near = d @ d.T >= 0.95
    np.fill_diagonal(near, False)
    by_id = {r["vec_id"]: r for r in got}
    found, true = sum(by_id[i]["n_links"] for i in range(1500)), int(near[:1500].sum())
    assert 0.99 * true <= found <= true and all(by_id[i]["n_links"] <= near[i].sum() for i in range(1500))
    for i in (2000, 2001, 2002, 2003, 2004):
        assert (by_id[i]["n_links"], by_id[i]["component_id"], by_id[i]["kept"]) == (0, i, True)
    assert by_id[2006]["component_id"] == 2005 and by_id[2006]["n_links"] == 1
    assert by_id[305]["component_id"] == by_id[299]["component_id"]
    assert cap_filters.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("n", [20_000, 10_000_000])
def test_recall_does_not_fall_with_the_number_of_rows(spark, n):
    random = np.random.default_rng(6)
    x, u = random.normal(size=(2, 300, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    u -= (x * u).sum(axis=1)[:, None] * x
    y = 0.95 * x + math.sqrt(1 - 0.95 ** 2) * u / np.linalg.norm(u, axis=1)[:, None]
    rows = [(i, 1, [float(c) for c in v]) for i, v in enumerate(np.concatenate([x, y]))]
    vectors = spark.createDataFrame(rows, "rep long, weight long, embedding array<double>")
    got = {r["rep"]: set(r["filters"]) for r in cap_filters.joined_filters(vectors, 64, n).collect()}
    assert sum(bool(got[i] & got[i + 300]) for i in range(300)) >= 299


def test_large_filters_are_cut_into_cells(spark, monkeypatch):
    monkeypatch.setattr(cap_filters, "CELL", 20)
    random = np.random.default_rng(4)
    middle = random.normal(size=16)
    rows = [(i, [float(v) for v in middle + random.normal(size=16) * 0.01]) for i in range(90)]
    got = cap_filters.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r["n_links"] for r in got} == {89} and {r["component_id"] for r in got} == {0}


def test_fixity_edge_cases(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * 5) for i in range(700)] + [(7, "http://h/7", "<p>7</p>" * 5), (None, "u", "v"), (None, None, None), (210, None, None), (310, "http://h/310", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    found = fixity.audit_pages(pages).collect()
    changed = {r["page_id"] for r in found if r["damage"] == "changed"}
    assert changed == {i for i in range(700) if i % 101 == 7} and {r["page_id"] for r in found if r["damage"] == "missing"} == {i for i in range(700) if i % 101 == 8}
    assert all(r["primary_root"] != r["replica_root"] and r["first_byte"] < r["last_byte"] for r in found)
    manifest = sorted(fixity.layout(pages).collect(), key=lambda r: (r["archive"], r["seq"]))
    for a, b in zip(manifest, manifest[1:], strict=False):
        assert a["archive"] != b["archive"] or (b["seq"], b["first_byte"]) == (a["seq"] + 1, a["last_byte"])
    assert fixity.audit_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_equal_replicas_are_not_descended(spark):
    leaf = spark.range(300).selectExpr("'a' AS archive", "id AS node", "id * 10 AS first_byte", "id * 10 + 10 AS last_byte", "sha2(cast(id AS string), 256) AS digest")
    assert fixity.audit(fixity.tree(leaf), fixity.tree(leaf)).count() == 0


def test_large_archives_are_split(spark, monkeypatch):
    monkeypatch.setattr(fixity, "PER_ARCHIVE", 10)
    pages = spark.range(400).selectExpr("cast(NULL AS bigint) AS page_id", "cast(id AS string) AS url", "repeat('x', cast(id % 50 AS int)) AS html")
    assert fixity.layout(pages).groupBy("archive").count().agg(F.max("count")).first()[0] < 40


def test_pipeline(spark, sf, docs):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, kept, sf)
        assert found.columns == docs.columns, name
        kept = spark.createDataFrame(found.collect(), docs.schema)
    want = bpe.encode_digests(kept, tokenizer_path()).collect()
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf).collect())) == Counter(map(tuple, want))


def test_pipeline_on_odd_and_empty_tables(spark, sf, odd, none):
    """Extra columns keep their own values through all stages that return documents, those named as results too."""
    named = odd.withColumn("lang_pred", F.lit("own")).withColumn("accepted", F.lit("own"))
    kept = named
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, kept, sf)
        assert found.columns == named.columns, name
        rows = found.collect()
        assert all((r["score"], r["size"], r["component_id"], r["lang_pred"], r["accepted"]) == ("x", "y", "z", "own", "own") for r in rows), name
        assert {(r["doc_id"], r["text"]) for r in rows} <= {(r["doc_id"], r["text"]) for r in kept.collect()}, name
        kept = spark.createDataFrame(rows, named.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    assert last.count() == kept.count() > 0
    empty = none
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
        assert empty.count() == 0
