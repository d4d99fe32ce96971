import hashlib
import re
import struct

import xxhash
from pyspark.sql import functions as F

from brickyard.llm import fingerprints as fp

M = (1 << 64) - 1


def chained(parts):
    seed = 42
    for part in parts:
        seed = xxhash.xxh64(part, seed=seed).intdigest()
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def sketch(text, k=5, s=2, size=64):
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    if not words:
        return []
    if len(words) < k:
        return [(chained(words) >> 33, 0)]
    runs = [signed(chained(words[i:i + s])) for i in range(len(words) - s + 1)]
    found = {}
    for i in range(len(words) - k + 1):
        inner = runs[i:i + k - s + 1]
        if min(inner) in (inner[0], inner[-1]):
            found.setdefault(chained([struct.pack("<q", r) for r in inner]) >> 33, i)
    return sorted(found.items())[:size]


def likeness(a, b, size=64, slack=64):
    if a == b:
        return 1.0
    ours, theirs = dict(a), dict(b)
    union = sorted(ours.keys() | theirs.keys())[:2 * size if len(a) < size and len(b) < size else size]
    shifts = [ours[h] - theirs[h] for h in union if h in ours and h in theirs]
    matched = max((sum(abs(o - t) <= slack for o in shifts) for t in shifts), default=0)
    return 2 * matched / (len(union) + matched)


def brute(rows):
    rows = [(i, t or "") for i, t in rows]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    out = []
    for at, (i, text) in enumerate(rows):
        after = rows[(at + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        own, changed, follower = sketch(text), sketch(edited), sketch(after)
        show = [",".join(f"{h:08x}:{p}" for h, p in x) for x in (own, changed)]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *show, round(likeness(own, changed), 12), round(likeness(own, follower), 12)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((*r[:5], round(r[5], 12), round(r[6], 12)) for r in df.collect()), key=repr)


def test_fingerprints_equal_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = fp.fingerprints(docs)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert rows_of(got) == brute(rows)
    long = got.where("n_chars > 600")
    near, far = long.agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert near > 0.7 and far < 0.1


def test_odd_rows(odd, odd_rows, none):
    assert rows_of(fp.fingerprints(odd)) == brute([(r[0], r[1]) for r in odd_rows])
    empty = fp.fingerprints(none)
    assert empty.count() == 0 and empty.schema == fp.fingerprints(odd).schema


def test_a_third_of_all_rows_alike(spark):
    shared = " ".join(f"shared{i}" for i in range(40))
    rows = [(i, shared if i % 3 == 0 else f"own text number {i} " * 5) for i in range(90)] + [(7, "seven \U0001F600 é" * 4)] * 30 + [(None, shared)] * 5
    got = rows_of(fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))
    assert got == brute(rows)
    assert len({r[3] for r in got if r[1] == len(shared)}) == 1


def test_anchors_do_not_depend_on_their_surroundings(spark):
    passage = " ".join(f"word{i * i % 61}x{i}" for i in range(50))
    texts = [(1, passage), (2, "something before " * 9 + passage), (3, passage + " and after " * 9), (4, "one word more " + passage.replace("word4x2 ", ""))]
    got = fp.with_sketch(spark.createDataFrame(texts, "doc_id long, text string"), "text", "a")
    got = fp.with_likeness(got.crossJoin(got.where("doc_id = 1").select(F.col("a").alias("b"))), "a", "b", "near")
    found = {r["doc_id"]: ({x >> 32: x & 0xFFFFFFFF for x in r["a"]}, r["near"]) for r in got.collect()}
    whole = found[1][0]
    assert found[1][1] == 1.0
    assert all(found[2][0][h] == p + 18 for h, p in whole.items()) and all(found[3][0][h] == p for h, p in whole.items())
    assert all(near > 0.5 for _, near in found.values())
    places = sorted(whole.values())
    assert max(b - a for a, b in zip(places, places[1:])) <= fp.K - fp.S
