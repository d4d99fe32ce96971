"""N-gram Jaccard join by PartEnum signatures (Arasu, Ganti, Kaushik 2006).

Sets of word shingles are put into bands of equal size. Two sets in a band (or at the edge of the next) with the wanted similarity differ in at most k
elements. The domain of shingles is hashed into k // (k2 + 1) + 1 parts; in one of them at least the sets differ by at most k2. Every part is hashed into n2
smaller ones, and each choice of n2 - k2 of them is a signature: similar sets share one for certain.

Below a similarity of 0.88 those choices hold two or three shingles, often none, and the sharper ones are many. There the first level signs whole parts of two
shingles or more, sparser ones only for the few sets that could else share none, and the second has parts of a given mean size and a relative pigeonhole: in one part that isn't empty the sets are as similar as on the whole, so they share what is left of it without at most m * (100 - percent) // 100 of its m
elements. Every such rest is a signature; none is empty.

Equal sets are one class. Of a signature's classes, each is verified against the smallest only (first among those of a chunk of rows, then among the chunks'
smallest), so a signature with many copies costs a row per copy and task, never all pairs. Where that leaves a signature with more than one component, its
remaining pairs across components are verified too, after sharper signatures if the signature is common. No link is lost.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickyard.llm.common import components, mix, ragged, steps, words
from brickyard.session import written

#: A band's largest size is its smallest times this.
BAND = 1.7
#: (k2, n2): differences allowed inside a part, and smaller parts in it; each level is complete by itself and sharper than the one before.
LEVELS = ((1, 3), (2, 6))
#: Below 0.88: most elements of a part on average for `wholes` (at 3, sets of 0.8 can nearly always sign from two elements on), mean elements of a part for `rests`.
LOOSE = (3.0, 4)

Level = tuple[int, int] | int | float
#: Classes of a signature whose cross pairs are listed; a larger one goes to the next level (the last level has no limit).
LISTED = 256
#: Signatures that are grouped inside a task before the shuffle.
CHUNK = 300_000
#: Words of 64 bits of the short parity sketch that the self-join of a signature's classes compares.
PARITY = 8
#: Bits of the filter for classes whose sets are fetched: a fixed size; a full filter only lets more rows through to the exact join.
FILTER_BITS = 23


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row's k-word shingles, sorted per row, and offsets. Fewer words are one shingle; no words, none."""
    hashes, marks = words(column)
    n = np.diff(marks)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    width = np.where(n >= k, k, n)
    at = ragged(marks[:-1], count)
    row = np.repeat(np.arange(len(n)), count)
    value = width[row].astype(np.uint64)
    for j in range(k):
        inside = j < width[row]
        value = np.where(inside, mix(value * np.uint64(0x9E3779B97F4A7C15) + hashes[np.minimum(at + j, max(len(hashes) - 1, 0))] if len(hashes) else value), value)
    out, size = [], np.zeros(len(n) + 1, np.int64)
    ends = np.concatenate([[0], np.cumsum(count)])
    for i, (a, b) in enumerate(itertools.pairwise(ends.tolist())):
        s = np.sort(value[a:b])
        s = s[np.concatenate([[True], s[1:] != s[:-1]])] if b > a + 1 else s
        out.append(s)
        size[i + 1] = len(s)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.cumsum(size)


def classes(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; equal sets have equal names."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)])
    return mix((sums[offsets[1:]] - sums[offsets[:-1]]) ^ (np.diff(offsets).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))).view(np.int64)


def bands(most: int) -> np.ndarray:
    """Smallest sizes of the bands."""
    low = [1]
    while low[-1] <= most:
        low.append(max(low[-1] + 1, int(low[-1] * BAND)))
    return np.array(low)


def rests(values: np.ndarray, offsets: np.ndarray, percent: int, mean: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures by the relative pigeonhole: all large enough rests of each part. A set signs for its own band, and for the next as in `signatures`."""
    size = np.diff(offsets)
    low = bands(int(size.max(initial=1)) * 2)
    own = np.searchsorted(low, size, side="right") - 1
    out, who = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for ahead in (0, 1):
        band = own + ahead
        least = low[np.minimum(band, len(low) - 1)]
        signs = (size > 0) & (size * (100 - percent) >= percent)
        if ahead:
            signs &= 100 * size >= percent * least
        rows = np.flatnonzero(signs)
        if not len(rows):
            continue
        parts, lengths = np.maximum(1, least[rows] * 5 // (4 * mean)), size[rows]
        at, row = ragged(offsets[:-1][rows], lengths), np.repeat(np.arange(len(rows)), lengths)
        u = mix(values[at] + band[rows][row].astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
        base = np.concatenate([[0], np.cumsum(parts)])
        place = base[row] + ((u >> np.uint64(40)) * parts[row].astype(np.uint64) >> np.uint64(24)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        place, item = place[order], mix(u ^ np.uint64(0x589965CC75374CC3))[order]
        heads = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        count, whole, place = np.diff(np.append(heads, len(place))), np.add.reduceat(item, heads), place[heads]
        mine = np.searchsorted(base, place, side="right") - 1
        salt = (band[rows][mine] * 1_000_003 + place - base[mine]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for m in np.unique(count).tolist():
            some = np.flatnonzero(count == m)
            inside = item[heads[some][:, None] + np.arange(m)]
            for gone in range(m * (100 - percent) // 100 + 1):
                choices = np.array(list(itertools.combinations(range(m), gone)), np.int64).reshape(math.comb(m, gone), gone)
                sums = whole[some][:, None] - inside[:, choices].sum(axis=2, dtype=np.uint64)
                out.append(mix(sums ^ salt[some][:, None]).ravel().view(np.int64))
                who.append(np.repeat(rows[mine[some]], len(choices)))
    return np.concatenate(out), np.concatenate(who)


def wholes(values: np.ndarray, offsets: np.ndarray, percent: int, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Signatures that are whole parts, with at most `most` elements to a part on average. Similar sets differ in at most m * (100 - percent) // percent elements,
    where m is the size of either, and an element spoils one part. A set with more parts of two elements than that shares one of them with every similar set and
    signs only these; else one with more filled parts signs those, and only another one its empty parts too. Of two similar sets that sign from one and from two
    elements on, both sign the part of two that they share."""
    size = np.diff(offsets)
    low = bands(int(size.max(initial=1)) * 2)
    own = np.searchsorted(low, size, side="right") - 1
    out, who = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for ahead in (0, 1):
        band = own + ahead
        signs = size * (100 - percent) >= percent
        if ahead:
            signs &= 100 * size >= percent * low[np.minimum(band, len(low) - 1)]
        rows = np.flatnonzero(signs)
        if not len(rows):
            continue
        highest, lengths = low[np.minimum(band[rows] + 1, len(low) - 1)] - 1, size[rows]
        parts = np.maximum(np.ceil(highest / most).astype(np.int64), 2 * (100 - percent) * highest // (100 + percent) + 1)
        at, row = ragged(offsets[:-1][rows], lengths), np.repeat(np.arange(len(rows)), lengths)
        u = mix(values[at] + band[rows][row].astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
        base = np.concatenate([[0], np.cumsum(parts)])
        place = base[row] + ((u >> np.uint64(40)) * parts[row].astype(np.uint64) >> np.uint64(24)).astype(np.int64)
        sums = np.zeros(int(base[-1]), np.uint64)
        np.add.at(sums, place, mix(u ^ np.uint64(0x589965CC75374CC3)))
        held = np.bincount(place, minlength=len(sums))
        mine, spoilt = np.repeat(np.arange(len(rows)), parts), lengths * (100 - percent) // percent
        least = sum((np.add.reduceat((held >= j).astype(np.int64), base[:-1]) > spoilt).astype(np.int64) for j in (1, 2))
        told = np.flatnonzero(held >= least[mine])
        salt = (band[rows][mine] * 1_000_003 + np.arange(len(sums)) - base[mine]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        out.append(mix(sums ^ salt)[told].view(np.int64))
        who.append(rows[mine[told]])
    return np.concatenate(out), np.concatenate(who)


def signatures(values: np.ndarray, offsets: np.ndarray, percent: int, level: Level) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the sets and the set of each. A set signs for its own band, and for the next if a set there can be similar to it."""
    if not isinstance(level, tuple):
        return (rests if isinstance(level, int) else wholes)(values, offsets, percent, level)
    k2, n2 = level
    size = np.diff(offsets)
    low = bands(int(size.max(initial=1)) * 2)
    own = np.searchsorted(low, size, side="right") - 1
    omitted = list(itertools.combinations(range(n2), k2))
    out, who = [], []
    for ahead in (0, 1):
        band = own + ahead
        highest = low[np.minimum(band + 1, len(low) - 1)] - 1
        differ = 2 * (100 - percent) * highest // (100 + percent)
        signs = (size > 0) & (differ > 0)
        if ahead:
            signs &= 100 * size >= percent * low[np.minimum(band, len(low) - 1)]
        rows = np.flatnonzero(signs)
        if not len(rows):
            continue
        parts = differ[rows] // (k2 + 1) + 1
        lengths = size[rows]
        at, row = ragged(offsets[:-1][rows], lengths), np.repeat(np.arange(len(rows)), lengths)
        u = mix(values[at] + band[rows][row].astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
        part = ((u >> np.uint64(40)) * parts[row].astype(np.uint64) >> np.uint64(24)).astype(np.int64)
        small = ((u & np.uint64(0xFFFFFF)) * np.uint64(n2) >> np.uint64(24)).astype(np.int64)
        base = np.concatenate([[0], np.cumsum(parts)])
        sums = np.zeros(int(base[-1]) * n2, np.uint64)
        np.add.at(sums, (base[row] + part) * n2 + small, mix(u ^ np.uint64(0x589965CC75374CC3)))
        sums = sums.reshape(-1, n2)
        whole = sums.sum(axis=1, dtype=np.uint64)
        place, mine = np.arange(len(whole)) - np.repeat(base[:-1], parts), np.repeat(np.arange(len(rows)), parts)
        salt = (band[rows][mine] * 1_000_003 + place).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for i, gone in enumerate(omitted):
            out.append(mix((whole - sums[:, list(gone)].sum(axis=1, dtype=np.uint64)) ^ salt + np.uint64(i)))
            who.append(rows[mine])
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out).view(np.int64), np.concatenate(who)


def stars(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows (k, class, pivot) from (signature, class) arrays. Within a chunk, a signature's smallest class goes on alone (k is the signature); each other class
    is a finished row with that one as its pivot (k is the signature xor the pivot)."""
    signs, names, n = [], [], 0

    def grouped() -> pa.RecordBatch:
        s, c = np.concatenate(signs), np.concatenate(names)
        order = np.lexsort((c, s))
        s, c = s[order], c[order]
        new = np.concatenate([[True], s[1:] != s[:-1]])
        keep = new | np.concatenate([[True], c[1:] != c[:-1]])
        pivot = c[np.flatnonzero(new)][np.cumsum(new) - 1]
        s, c, new, pivot = s[keep], c[keep], new[keep], pivot[keep]
        return pa.RecordBatch.from_arrays([pa.array(np.where(new, s, s ^ pivot)), pa.array(c), pa.array(pivot, mask=new)], ["k", "class", "pivot"])

    for s, c in parts:
        signs.append(s)
        names.append(c)
        n += len(s)
        if n >= CHUNK:
            yield grouped()
            signs, names, n = [], [], 0
    if n:
        yield grouped()


def starred(rows: DataFrame) -> DataFrame:
    """(sign, p, x): every class of a shared signature beside the smallest of its chunk, and chunks' smallest beside the smallest of all."""
    least = F.expr("min(class) over (partition by k)")
    p = F.coalesce("pivot", least)
    sign = F.when(F.col("pivot").isNull(), F.col("k")).otherwise(F.col("k").bitwiseXOR(F.col("pivot")))
    return rows.select(sign.alias("sign"), p.alias("p"), F.col("class").alias("x")).where("p <> x")


def bitmap(names: DataFrame) -> np.ndarray:
    """The fixed-size filter of some classes."""
    mask = (1 << FILTER_BITS) - 1
    cells = names.selectExpr(f"shiftright(class & {mask}L, 5) AS w", "shiftleft(1L, CAST(class & 31L AS INT)) AS b").groupBy("w").agg(F.bit_or("b").alias("b"))
    found = cells.toArrow()
    out = np.zeros(1 << (FILTER_BITS - 5), np.int64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return out


def flips(values: np.ndarray, offsets: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity sketches end to end as 64-bit words, and offsets: every element flips one of a set's `bits` (powers of two, 64 at least).

    The bits in which the sketches of two sets differ are no more than the elements in which the sets differ.
    """
    place = mix(values ^ np.uint64(0x1D8E4E27C47D124F))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ends = np.concatenate([[0], np.cumsum(bits // 64)])
    at = (place & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    out = np.zeros(int(ends[-1]), np.uint64)
    np.bitwise_xor.at(out, ends[row] + (at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    return out, ends


def folded(x: np.ndarray, size: int) -> np.ndarray:
    """A sketch with fewer bits."""
    return np.bitwise_xor.reduce(x.reshape(-1, size), axis=0)


def sketch_columns(side: str) -> list[Column]:
    return [F.col("class").alias(side), F.col("n").alias("n_" + side), *(F.col(f"s{i}").alias(f"s{i}_{side}") for i in range(PARITY))]


def possible(percent: int) -> Column:
    """False only for pairs a, b that surely aren't similar: their sketches differ in more bits than similar sets of their sizes in elements."""
    differ = " + ".join(f"bit_count(s{i}_a ^ s{i}_b)" for i in range(PARITY))
    return F.expr(f"{100 + percent} * ({differ}) <= {100 - percent} * (n_a + n_b)")


def plausible(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """(a, b, possible) by the long sketches, whose length goes with the set's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "x", "y")), strict=True):
                most = (100 - percent) * (n + m) // (100 + percent)
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                size = min(len(x), len(y))
                found.append(abs(n - m) <= most and int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()) <= most)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.bool_())], ["a", "b", "possible"])

    left = own.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("flips").alias("x"))
    right = own.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("flips").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "x", "y").mapInArrow(run, "a long, b long, possible boolean")


def some(rows: DataFrame) -> bool:
    return rows.limit(1).count() > 0


def linked(pairs: DataFrame, own: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b, similar) of pairs of classes. Whole sets are fetched for pairs that the sketches don't rule out."""
    near = written(plausible(pairs, own, percent))
    if not some(near.where("possible")):
        return near.select("a", "b", F.col("possible").alias("similar"))
    names = written(near.where("possible").select(F.explode(F.array("a", "b")).alias("class")).distinct())
    sets = written(sets_of(texts, names, k))
    left = sets.select(F.col("class").alias("a"), F.col("items").alias("own"))
    right = sets.select(F.col("class").alias("b"), F.col("items").alias("other"))
    both = near.where("possible").join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("own", "other"))
    sure = written(both.select("a", "b", (100 * shared >= percent * (F.size("own") + F.size("other") - shared)).alias("similar")))
    return sure.unionByName(near.where("NOT possible").select("a", "b", F.lit(False).alias("similar")))


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, class, the short sketch s0.. and the long one `flips`."""
    short = [f"s{i}" for i in range(PARITY)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in steps(b, "text")):
            values, offsets = shingle_sets(part.column("text"), k)
            size = np.diff(offsets)
            few, _ = flips(values, offsets, np.full(len(size), 64 * PARITY))
            few = few.reshape(-1, PARITY).view(np.int64)
            many, ends = flips(values, offsets, 1 << np.maximum(6, np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64)))
            raw = many.tobytes()
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(size), pa.array(classes(values, offsets)), *(pa.array(few[:, i]) for i in range(PARITY)),
                pa.array([raw[8 * a:8 * b] for a, b in itertools.pairwise(ends.tolist())], pa.binary())], ["doc_id", "n_shingles", "class", *short, "flips"])

    return docs.mapInArrow(run, f"doc_id long, n_shingles long, class long, {', '.join(c + ' long' for c in short)}, flips binary")


def first_stars(texts: DataFrame, k: int, percent: int, level: Level) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for part in (p for b in batches for p in steps(b, "text")):
                values, offsets = shingle_sets(part.column("text"), k)
                names = classes(values, offsets)
                _, once = np.unique(names, return_index=True)
                if len(once) < len(names):
                    lengths = np.diff(offsets)[once]
                    values, names = values[ragged(offsets[:-1][once], lengths)], names[once]
                    offsets = np.concatenate([[0], np.cumsum(lengths)])
                signs, who = signatures(values, offsets, percent, level)
                yield signs, names[who]

        yield from stars(parts())

    return texts.mapInArrow(run, "k long, class long, pivot long")


def sets_of(texts: DataFrame, names: DataFrame, k: int) -> DataFrame:
    """(class, items) for the named classes."""
    sent = texts.sparkSession.sparkContext.broadcast(bitmap(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in steps(b, "text")):
            values, offsets = shingle_sets(part.column("text"), k)
            own = classes(values, offsets)
            bit = own & ((1 << FILTER_BITS) - 1)
            _, once = np.unique(own, return_index=True)
            rows = once[(sent.value[bit[once] >> 5] >> (bit[once] & 31) & 1).astype(bool)]
            lengths = np.diff(offsets)[rows]
            items = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values[ragged(offsets[:-1][rows], lengths)].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(own[rows]), items], ["class", "items"])

    found = texts.mapInArrow(run, "class long, items array<long>").join(names, "class", "left_semi")
    return found.groupBy("class").agg(F.first("items").alias("items"))


def finer_stars(sets: DataFrame, percent: int, level: Level) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in (b.slice(i, 16) for b in batches for i in range(0, b.num_rows, 16)):
                lists = batch.column("items")
                offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
                signs, who = signatures(lists.flatten().to_numpy().view(np.uint64), offsets, percent, level)
                yield signs, batch.column("class").to_numpy()[who]

        yield from stars(parts())

    return sets.mapInArrow(run, "k long, class long, pivot long")


def unsettled(star: DataFrame, wrong: DataFrame, labels: DataFrame) -> DataFrame:
    """(sign, class, label, n, least) of signatures with more than one component, from the star rows and the pairs in them that failed; `least` is the smallest
    of the n classes. The only pair of two classes is a star, so it has been tried."""
    open_signs = star.join(wrong, (F.col("p") == F.col("a")) & (F.col("x") == F.col("b")), "left_semi").select("sign").distinct()
    rows = star.join(open_signs, "sign")
    members = rows.select("sign", F.explode(F.array("x", "p")).alias("class")).distinct()
    members = members.join(labels, F.col("class") == F.col("id"), "left").select("sign", "class", F.coalesce("component_id", "class").alias("label"))
    spread = members.groupBy("sign").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.count("*").alias("n"), F.min("class").alias("least"))
    return members.join(spread.where("l < h AND n > 2").select("sign", "n", "least"), "sign")


def families(rest: DataFrame) -> DataFrame:
    """(family, class, label): near copies share many signatures, whose classes are much the same. Those with one smallest class become one family where that has
    fewer pairs than they have one by one; else each is a family by itself. Every pair of a signature is in a family."""
    together = rest.groupBy("least", "class").agg(F.first("label").alias("label"), F.sum("n").alias("apart"))
    fewer = written(together.groupBy("least").agg(F.count("*").alias("size"), F.sum("apart").alias("apart")).where("size * size <= apart").select("least"))
    joined = together.join(fewer, "least", "left_semi").select(F.col("least").alias("family"), "class", "label")
    return joined.unionByName(rest.join(fewer, "least", "left_anti").select(F.col("sign").alias("family"), "class", "label"))


def similar_classes(texts: DataFrame, own: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, component_id) of the classes that are linked with others. `own`: class, n and sketches.

    Components found so far stand for all links in them: later links join those, and without such links nothing is computed anew.
    """
    levels = LEVELS if percent >= 88 else LOOSE
    labels, fresh = None, []

    def found(pairs: DataFrame) -> DataFrame:
        tried = linked(pairs, own, texts, k, percent)
        more = tried.where("similar").select("a", "b")
        if labels is None or some(more):
            fresh.append(more)
        return tried

    def components_now() -> DataFrame:
        known = [] if labels is None else [labels.select(F.col("id").alias("a"), F.col("component_id").alias("b"))]
        return components(reduce(DataFrame.unionByName, known + fresh)) if fresh else labels

    for depth, level in enumerate(levels):
        if depth == 0:
            star = written(starred(first_stars(texts, k, percent, level)))
        else:
            star = written(starred(finer_stars(sets_of(texts, common, k), percent, level)))
        tried = found(star.select(F.col("p").alias("a"), F.col("x").alias("b")).distinct())
        labels, fresh = components_now(), []
        wrong = tried.where("NOT similar").select("a", "b")
        if not some(wrong):
            break
        rest = written(unsettled(star, wrong, labels))
        last = depth + 1 == len(levels)
        listed = families(rest if last else rest.where(F.col("n") <= LISTED))
        left, right = (listed.select("family", F.col("class").alias(c), F.col("label").alias("label_" + c)).join(own.select(*sketch_columns(c)), c) for c in "ab")
        cross = left.join(right, (left["family"] == right["family"]) & F.expr("a < b AND label_a <> label_b") & possible(percent)).select("a", "b").distinct()
        untried = written(cross.join(tried.select("a", "b"), ["a", "b"], "left_anti"))
        if some(untried):
            found(untried)
        common = written(rest.where(F.col("n") > LISTED).select("class").distinct())
        if last or not some(common):
            break
    return components_now()


def join_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, class, component_id: one row per row of `docs`.

    Words are the runs outside `[\\x20\\x09-\\x0D]` after lower-casing A-Z; a document's set holds its distinct k-word shingles, or all its words as one if there
    are fewer. Two documents link when percent of the union is shared. component_id is the smallest doc_id reachable by links, itself included. Null and empty
    texts have no set and link with nothing (component_id is their own doc_id). Rows without an id count in links, but name no component unless none of it has an
    id (null then). Repeated rows link with each other. An empty table gives an empty result; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = written(sketch(texts, k))
    kept = [F.first(c).alias(c) for c in (*(f"s{i}" for i in range(PARITY)), "flips")]
    own = written(rows.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), *kept))
    labels = similar_classes(texts.select("text"), own, k, percent)
    named = own.join(labels, F.col("class") == F.col("id"), "left").select("class", F.coalesce("component_id", "class").alias("label"), "least")
    group = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_class = named.join(group, "label").select("class", "component_id")
    alone = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return rows.where("n_shingles > 0").join(by_class, "class").select("doc_id", "n_shingles", "class", "component_id").unionByName(
        alone.select("doc_id", "n_shingles", "class", "component_id"))


def keep(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, with all their columns, that stay: of each component the document with the smallest id (repeated rows of it too)."""
    gone = written(join_components(docs, k, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("__id")).distinct())
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__id"), "left_anti")


ORACLE = r"""
WITH RECURSIVE t AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS items FROM t),
e AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b FROM e AS x JOIN e AS y ON x.item = y.item AND x.doc_id < y.doc_id AND 10 * x.n >= 9 * y.n AND 10 * y.n >= 9 * x.n
    GROUP BY ALL HAVING 100 * count(*) >= 90 * (any_value(x.n) + any_value(y.n) - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, CAST(len(any_value(s.items)) AS BIGINT) AS n_shingles, min(r.b) AS component_id FROM s JOIN r ON r.a = s.doc_id GROUP BY s.doc_id
"""
