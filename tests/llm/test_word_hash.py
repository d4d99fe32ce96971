"""Words that a hash which only sums letters by place can't tell apart, and words whose hashes are made equal."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from brickyard.llm import bpe, common, ngram_join, suffix_tree
from brickyard.llm.queries import tokenizer_path

SIZES = (64, 512, 1024, 4096)


def thue_morse(n):
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", SIZES)
def test_hashes_differ(n):
    x, y = thue_morse(n)
    hashes, _ = common.words(pa.array([x, y, x.upper(), x + "a", x[:-1], "", "a " + x + "\n" + y]))
    assert hashes[0] == hashes[2] == hashes[6] and hashes[1] == hashes[7] and len(set(hashes.tolist())) == 5


def test_hashes_of_words_do_not_depend_on_their_place():
    words = [("é" * i + "x" * j).encode() for i in range(6) for j in range(300) if i + j]
    data = np.frombuffer(b"\0".join(words), np.uint8)
    lengths = np.array(list(map(len, words)))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    got = common.word_hashes(data, starts, lengths)
    alone = [common.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words]
    assert got.tolist() == [int(h) for h in alone] and len(set(got.tolist())) == len(set(words))
    assert not set(got.tolist()) & set(common.word_hashes(data, starts, lengths, seed=1).tolist())


def test_encoding(spark):
    own = Tokenizer.from_file(tokenizer_path())
    texts = [t for n in SIZES for x, y in [thue_morse(n)] for t in (x, y, f"{x} q {y}")]
    rows = bpe.encode_digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), tokenizer_path()).collect()
    want = {i: hashlib.sha256(np.array(own.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest() for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["ids_sha256"] for r in rows} == want


def test_encoding_when_all_hashes_are_equal(monkeypatch):
    monkeypatch.setattr(bpe, "word_hashes", lambda data, starts, lengths: np.zeros(len(starts), np.uint64))
    own, encoder = Tokenizer.from_file(tokenizer_path()), bpe.Encoder(tokenizer_path())
    for texts in (["alpha beta", "gamma beta alpha"], ["beta", "delta gamma alphabet"], ["alpha <|endoftext|> <|ENDOFTEXT|> beta!"]):
        got = encoder.encode_stretches([t.encode() for t in texts])
        assert [np.frombuffer(ids, "<u4").tolist() for ids, _ in got] == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_near_copies_and_scores(spark):
    x, y = thue_morse(1024)
    texts = [x, y, x + " q r", y + " q r"] + [f"filler number {i}" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.join_components(df).collect()} == {i: i for i in range(len(texts))}
    scores = {r["doc_id"]: r for r in suffix_tree.score(df).collect()}
    learnt = [t.split() + [None] for r, t in zip([scores[i] for i in range(len(texts))], texts) if not r["held_out"]]
    counts = {}
    for w in (w for ws in learnt for w in ws):
        counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    for i, text in enumerate(texts):
        ws = text.split() + [None]
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        assert scores[i]["base_score"] == pytest.approx(base) and scores[i]["n_known"] == sum(w in counts for w in ws)
