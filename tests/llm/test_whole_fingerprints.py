"""Fingerprints with all anchors, held against the same anchors found one by one."""

import hashlib

from brickyard.llm import fingerprints as fp
from brickyard.llm import queries

from .test_fingerprints import likeness, rows_of, sketch

ALL = 1 << 40


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    out = []
    for at, (i, text) in enumerate(rows):
        after = rows[(at + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        own, changed, follower = (sketch(t, size=ALL) for t in (text, edited, after))
        show = [",".join(f"{h:08x}:{p}" for h, p in x) for x in (own, changed)]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *show, round(likeness(own, changed, size=ALL), 12), round(likeness(own, follower, size=ALL), 12)))
    return sorted(out, key=repr)


def test_query_drops_no_anchor(spark, sf, docs):
    got = rows_of(queries.QUERIES["op13_closed_syncmers"](spark, sf))
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert max(r[3].count(":") for r in got) > fp.SKETCH


def test_moved_passages(spark):
    """Blocks in another order: anchors of some agree on one shift, those of others on another one; repeated blocks count where they first stand."""
    block = [" ".join(f"w{b}x{i * i % 97}y{i}" for i in range(90 + 40 * b)) for b in range(4)]
    orders = [(0, 1, 2, 3), (3, 2, 1, 0), (0, 2, 1, 3), (1, 1, 0, 3), (2, 3), (0, 1, 2, 3), (3, 0)]
    rows = [(i, " ".join(block[b] for b in order)) for i, order in enumerate(orders)] + [(None, block[0]), (None, block[0]), (9, None), (8, "few words")]
    got = rows_of(fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), sketch=None))
    assert got == brute(rows)


def test_agreeing_shifts(spark):
    shifts = [[], [5], [0, 64], [0, 65], [-70, -3, -3, 0, 61, 62, 125], [i * 30 for i in range(-9, 9)], [-500] * 3 + [0, 1] + [700] * 4]
    rows = [(sorted(x), max((sum(abs(o - t) <= 64 for o in x) for t in x), default=None)) for x in shifts]
    got = spark.createDataFrame(rows, "t array<long>, most int").select("most", fp.agreeing("t", 64).alias("m")).collect()
    assert all(r["most"] == r["m"] for r in got)
