"""Operators against brute force, on the small table and on a table of edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from brickyard.llm import bpe, exact_dedup, mixing, ngram_join, sharding
from brickyard.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(params=["docs", "odd"])
def table(request):
    return request.getfixturevalue(request.param)


def test_bpe_equals_whole_text_encoding(table):
    own = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in table.select("doc_id", "text").collect():
        ids = own.encode(r["text"] or "", add_special_tokens=False).ids
        want[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe.encode_digests(table, tokenizer_path()).collect()) == want


def test_bpe_gives_ids_and_text(odd):
    for r in bpe.encode(odd, tokenizer_path()).where("doc_id = 8").collect():
        assert r["decoded"] == "1</w> 2</w> 3</w> 4</w> !!</w>" and len(r["ids"]) == 5


def test_chunks_are_reused_and_cut_by_content():
    shared = " ".join(f"shared passage number {i * 7919 % 1009}" for i in range(300))
    texts = [f"{'head ' * k}{shared} tail {k}".encode() for k in range(3)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    ends = bpe.cuts(data, offsets)
    own = [{bytes(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True) if lo <= a and b <= hi} for lo, hi in zip(offsets[:-1], offsets[1:], strict=True)]
    assert len(own[0] & own[1] & own[2]) > 5


def test_shards(table):
    rows = sharding.interleave(table).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in table.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots, sources = defaultdict(list), defaultdict(Counter)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sources[r["source"]][r["shard"]] += 1
    sizes = [len(slots[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(abs(n - sum(c.values()) / 8) < 2 for c in sources.values() for n in c.values())
    assert Counter(map(tuple, rows)) == Counter(map(tuple, sharding.interleave(table.repartition(5)).collect()))


def reshared(sizes, share=1.5, cap=2, weights=(3, 1, 2)):
    total, left = share * sum(sizes), dict(enumerate(sizes))
    out, open_ = {}, set(left)
    while True:
        w = sum(weights[i % 3] for i in open_)
        rest = total - sum(out.values())
        over = [i for i in open_ if rest * weights[i % 3] / w > cap * sizes[i]]
        if not over:
            return [out.get(i, rest * weights[i % 3] / w if w else 0) for i in range(len(sizes))]
        for i in over:
            out[i] = cap * sizes[i]
            open_.discard(i)


def test_mix(table):
    rows = mixing.mix_sources(table).collect()
    docs = table.collect()
    size = {id(r): len(WORD.findall(r["text"] or "")) for r in docs}
    names = sorted({r["source"] for r in docs}, key=lambda s: (s is None, s or ""))
    sums = [sum(size[id(r)] for r in docs if r["source"] == s) for s in names]
    goal = dict(zip(sums, reshared(sums), strict=True))
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((r["doc_id"], size[id(r)]) for r in docs)
    for r in rows:
        assert r["target"] == pytest.approx(goal[r["source_size"]]) and r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
    taken = Counter()
    for r in rows:
        taken[r["source_size"], r["target"]] += r["taken"]
    largest = max(size.values())
    for (_, target), n in taken.items():
        assert abs(n - target) <= (0.02 * target + 2 if table.count() > 100 else largest)
    mix = Counter(r["doc_id"] for r in mixing.take(table).collect())
    want = Counter()
    for r in rows:
        want[r["doc_id"]] += r["copies"]
    assert mix == +want


def test_fit_closes_the_budget():
    assert sum(a * b for a, b in zip([3, 5, 7], mixing.fit([3, 5, 7], [2, 2, 2], 13, 30), strict=True)) == 13
    random = np.random.default_rng(1)
    for _ in range(50):
        lengths = sorted(set(random.integers(1, 40, 8).tolist()))
        counts = random.integers(1, 5, len(lengths)).tolist()
        total = sum(a * b for a, b in zip(lengths, counts, strict=True))
        budget = int(random.integers(0, total))
        taken = mixing.fit(lengths, counts, budget, total)
        assert all(0 <= t <= c for t, c in zip(taken, counts, strict=True)) 
        reach = {0}
        for n, c in zip(lengths, counts, strict=True):
            reach = {r + n * k for r in reach for k in range(c + 1)}
        assert sum(a * b for a, b in zip(lengths, taken, strict=True)) == max(r for r in reach if r <= budget)


def test_exact_dedup(table):
    clean = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for r in table.collect():
        groups[clean(r["text"])].append(r["doc_id"])
    want, kept = Counter(), Counter()
    for text, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        kept[first, hashlib.sha256(text.encode()).hexdigest()] += 1
        want += Counter((i, first, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids)
    rows = exact_dedup.decisions(table.repartition(5)).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == want
    assert Counter((r["doc_id"], r["text_sha256"]) for r in rows if r["kept"]) == kept
    left = exact_dedup.keep(table)
    assert left.columns == table.columns and Counter((r["doc_id"], hashlib.sha256(clean(r["text"]).encode()).hexdigest()) for r in left.collect()) == kept


def test_exact_dedup_rounds(docs):
    one = Counter(map(tuple, exact_dedup.decisions(docs.repartition(40)).collect()))
    assert one == Counter(map(tuple, exact_dedup.decisions(docs, rounds=2).collect()))


def components_by_force(rows, k, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(low))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and percent * max(len(a), len(b)) <= 100 * min(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = label[i], label[j]
                label = [min(x, y) if v in (x, y) else v for v in label]
    least = {}
    for v, (i, _) in zip(label, rows, strict=True):
        if i is not None:
            least[v] = min(least.get(v, i), i)
    return Counter((r[0], len(s), least.get(v) if s else r[0]) for r, s, v in zip(rows, sets, label, strict=True))


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_ngram_join(spark, table, k, percent):
    rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    got = ngram_join.join_components(table, k, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == components_by_force(rows, k, percent)


@pytest.mark.parametrize("percent", [80, 90])
def test_ngram_join_loses_no_link_in_large_groups(spark, monkeypatch, percent):
    """Chains of edits around one text, and a passage that many short texts share, with small limits so that all levels run."""
    monkeypatch.setattr(ngram_join, "LISTED", 4)
    monkeypatch.setattr(ngram_join, "CHUNK", 500)
    random = np.random.default_rng(3)
    base = [f"w{x}" for x in random.integers(0, 400, 60)]
    rows = []
    for i in range(90):
        text = list(base[:40 + int(random.integers(0, 20))])
        for _ in range(int(random.integers(0, 4))):
            text[int(random.integers(0, len(text)))] = f"x{int(random.integers(0, 50))}"
        rows.append((i, " ".join(text)))
    got = ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 3, percent)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == components_by_force(rows, 3, percent)


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("level", [(1, 2), (1, 3), (2, 6), 3.6, 4, 6])
def test_similar_sets_share_a_signature(percent, level):
    random = np.random.default_rng(5)
    for _ in range(120):
        n = int(random.integers(1, 200))
        a = random.integers(1, 2**63, n, dtype=np.uint64)
        drop = int(random.integers(0, max(1, n * (100 - percent) // 100 + 1)))
        b = a[drop:]
        extra = (100 * len(b) - percent * n) // percent
        b = np.concatenate([b, random.integers(1, 2**63, max(0, extra), dtype=np.uint64)])
        if len(b) and 100 * (n - drop) >= percent * (n + max(0, extra)) and (drop or extra > 0):
            (x, _), (y, _) = (ngram_join.signatures(np.sort(s), np.array([0, len(s)]), percent, level) for s in (a, b))
            assert np.intersect1d(x, y).size


def test_empty_tables(none):
    assert bpe.encode_digests(none, tokenizer_path()).count() == 0
    assert sharding.interleave(none).count() == 0 and mixing.mix_sources(none).count() == 0 and mixing.take(none).count() == 0
    assert exact_dedup.decisions(none).count() == 0 and exact_dedup.keep(none).count() == 0
    assert ngram_join.join_components(none).count() == 0 and ngram_join.keep(none).count() == 0


@pytest.mark.parametrize("pair", [("<|endoftext|>", "<|ENDOFTEXT|>"), ("<|startoftext|>", "<|StartOfText|>"), ("j\u030c", "J\u030c"), ("t\u0308", "T\u0308")])
def test_spellings_that_differ_in_case_only(pair):
    for texts in (pair, pair[::-1]):
        own = bpe.Encoder(tokenizer_path())
        found = own.documents([t.encode() for t in texts], [[], []])
        assert [np.frombuffer(ids, "<u4").tolist() for ids, _ in found] == [own.whole.encode(t, add_special_tokens=False).ids for t in texts]
