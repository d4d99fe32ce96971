"""Periodic runs of words on a Re-Pair grammar.

The words of each text are replaced pair by pair: round after round, every pair of neighbouring symbols that occurs twice or more in the text and more often than
the pairs that overlap it becomes a rule. A run that lies inside a rule's expansion crosses the boundary between its two halves or those of a rule
below, so runs are looked for at one place of each rule's boundary and at the boundaries that no rule covers, and then carried to all places where
the rule was put. What the rules give is merged to maximal stretches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickyard.llm.common import SPACES, mix, ragged, row_of, spans, steps, text_bytes

#: A run has this many words and this many periods at least.
LEAST, POWER = 6, 4
#: Periods below are tried one by one; longer ones are found by word sequences of this length and its doubles.
FIRST = 8
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
Interval = tuple[int, int, int]


def long_enough(length: int, period: int) -> bool:
    return length >= max(LEAST, POWER * period)


class Grammar:
    """Rules over words that lie end to end with one place between two texts: for each place where a rule was put its rule, start, middle and end."""

    def __init__(self, word: np.ndarray, at: np.ndarray, text: np.ndarray):
        symbol, start, end, names = word.astype(np.int64), at.astype(np.int64), at.astype(np.int64) + 1, int(word.max(initial=0)) + 1
        rounds: list[tuple[np.ndarray, ...]] = []
        while len(symbol) > 1:
            left = np.flatnonzero(end[:-1] == start[1:])
            found = self.choose(left, (text[left] * names + symbol[left]) * names + symbol[left + 1])
            if found is None:
                break
            live, chosen, rule, rules = found
            put = left[chosen]
            rounds.append((names + rule, start[put], end[put], end[put + 1]))
            symbol[put], end[put] = names + rule, end[put + 1]
            keep = np.zeros(len(symbol), bool)
            keep[left[live]] = keep[left[live] + 1] = True  # pairs that aren't repeated now never will be
            keep[put + 1] = False
            symbol, start, end, text, names = symbol[keep], start[keep], end[keep], text[keep], names + rules
        empty = np.empty(0, np.int64)
        self.rule, self.start, self.middle, self.end = (np.concatenate(part) if rounds else empty for part in (zip(*rounds) if rounds else [()] * 4))
        order = np.lexsort((self.start, self.rule))
        self.rule, self.start, self.middle, self.end = self.rule[order], self.start[order], self.middle[order], self.end[order]
        self.first = np.ones(len(order), bool)
        self.first[1:] = self.rule[1:] != self.rule[:-1]

    @staticmethod
    def choose(left: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int] | None:
        """Which pairs are repeated, which are replaced now, the replaced ones' rule numbers and how many rules; None if no pair is repeated."""
        if not len(left):
            return None
        after = np.zeros(len(left) + 1, bool)
        after[1:-1] = left[1:] == left[:-1] + 1
        same = after.copy()
        same[1:-1] &= pair[1:] == pair[:-1]
        place = np.arange(len(left))
        even = (place - np.maximum.accumulate(np.where(same[:-1], 0, place))) % 2 == 0  # of x x x x the first and third pair
        order = np.argsort(pair)
        new = np.ones(len(left), bool)
        new[1:] = pair[order][1:] != pair[order][:-1]
        group = np.empty(len(left), np.int64)
        group[order] = np.cumsum(new) - 1
        count = np.bincount(group, weights=even).astype(np.uint64)
        if count.max() < 2:
            return None
        rank = np.where(count >= 2, (count << np.uint64(32)) | (mix(np.arange(len(count), dtype=np.uint64)) >> np.uint64(32)), np.uint64(0))[group]
        ahead, behind = np.zeros(len(left), np.uint64), np.zeros(len(left), np.uint64)
        ahead[1:], behind[:-1] = np.where(after[1:-1], rank[:-1], 0), np.where(after[1:-1], rank[1:], 0)
        live = rank > 0
        chosen = live & even & ((rank > ahead) | same[:-1]) & ((rank > behind) | same[1:])
        uses = np.bincount(group[chosen], minlength=len(count))
        number = np.cumsum(uses >= 2) - 1
        chosen &= uses[group] >= 2
        if not chosen.any():
            return None
        return live, chosen, number[group[chosen]], int(number[-1]) + 1


def short_periods(word: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(period, boundaries) that a run of a period below FIRST may cross: on one side of the boundary it has two periods, and the word on the other side agrees."""
    for q in range(1, FIRST):
        equal = np.zeros(len(word) + 3 * q + 2, bool)
        equal[q + 1:q + 1 + max(len(word) - q, 0)] = word[:-q] == word[q:]  # equal[q + 1 + i]: word i is word i + q
        found = []
        for at in (bounds + q, bounds + 1 - q):  # q + 1 places from i = m - 1, or from i = m - 2q
            hit = np.flatnonzero((at >= 0) & equal[at] & equal[np.maximum(at, 0) + 1])
            for k in range(2, q + 1):
                hit = hit[equal[at[hit] + k]]
            found.append(bounds[hit])
        if any(map(len, found)):
            yield q, np.unique(np.concatenate(found))


def long_periods(word: np.ndarray, text: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(period, boundaries) for periods from FIRST on, those from a length to its double together, found where the word sequence of that length beside a boundary recurs.

    Equal hashes only propose: what they give is compared word by word later. Sequences that don't recur within a text are left out of the next doubling.
    """
    bits = np.uint64(max(3 * len(word) + 1, 2).bit_length())
    hashed = mix(word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(text.astype(np.uint64)))
    length, alive = 1, np.arange(len(word))
    is_bound = np.zeros(len(word) + 1, bool)
    is_bound[bounds] = True
    while len(alive):
        if length >= FIRST:
            keys = np.sort((hashed[alive] >> bits << bits) | alive.astype(np.uint64))
            recurs = (keys[1:] >> bits) == (keys[:-1] >> bits)
            kept = np.zeros(len(keys), bool)
            kept[1:] |= recurs
            kept[:-1] |= recurs
            keys = keys[kept]
            alive = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            there = np.zeros(len(word) + 1, bool)
            there[alive] = True
            yield from recurring(word, hashed, there, keys, alive, bits, length, is_bound)
            alive = np.sort(alive)
        else:
            there = np.zeros(len(word) + 1, bool)
            there[alive] = True
        ahead = alive[alive + length < len(word)]
        ahead = ahead[there[ahead + length]]
        hashed[ahead] = mix(hashed[ahead] * np.uint64(0xD6E8FEB86659FD93) + hashed[ahead + length]) if len(ahead) else hashed[ahead]
        alive, length = ahead, length * 2


def recurring(word: np.ndarray, hashed: np.ndarray, there: np.ndarray, keys: np.ndarray, alive: np.ndarray, bits: np.uint64, length: int,
              is_bound: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    def pairs(rows: np.ndarray, ahead: bool) -> tuple[np.ndarray, np.ndarray]:
        near, far = np.uint64(length), np.uint64(2 * length - 1)
        group, at = keys[rows] >> bits << bits, alive[rows].astype(np.uint64)
        if ahead:
            lo, hi = np.searchsorted(keys, group | (at + near)), np.searchsorted(keys, group | (at + far), side="right")
        else:
            lo, hi = (np.searchsorted(keys, group | np.where(at >= d, at - d, np.uint64(0)), side=s) for d, s in ((far, "left"), (near, "right")))
            hi = np.where(at >= near, hi, lo)
        return np.repeat(rows, hi - lo), ragged(lo, hi - lo)

    def same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        inside = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(word))
        a, b = np.where(inside, a, 0), np.where(inside, b, 0)
        return inside & there[a] & there[b] & (hashed[a] == hashed[b])

    one, two = pairs(np.flatnonzero(is_bound[alive]), ahead=True)
    m, q = alive[one], alive[two] - alive[one]
    good = same(m + q - length, m + 2 * q - length) & (word[m - 1] == word[m - 1 + q])
    one, two = pairs(np.flatnonzero(is_bound[np.minimum(alive + length, len(word))]), ahead=False)
    n, p = alive[one] + length, alive[one] - alive[two]
    fine = same(n - p, n - 2 * p) & (n < len(word)) & (word[np.minimum(n, len(word) - 1)] == word[np.minimum(n, len(word) - 1) - p])
    m, q = np.concatenate([m[good], n[fine]]), np.concatenate([q[good], p[fine]])
    order = np.lexsort((m, q))
    m, q = m[order], q[order]
    for part in np.split(np.arange(len(q)), np.flatnonzero(np.diff(q)) + 1):
        if len(part):
            yield int(q[part[0]]), np.unique(m[part])


def agree(word: np.ndarray, a: int, b: int, back: bool) -> int:
    """How many words from places a and b on (back: before them) are the same; a < b."""
    n, step = 0, 32
    while True:
        if back:
            x, y = word[max(a - n - step, 0):max(a - n, 0)][::-1], word[max(b - n - step, 0):b - n][::-1]
        else:
            x, y = word[a + n:a + n + step], word[b + n:b + n + step]
        size = min(len(x), len(y))
        other = np.flatnonzero(x[:size] != y[:size])
        if len(other):
            return n + int(other[0])
        if size < step:
            return n + size
        n, step = n + step, step * 2


class Crossing:
    """Runs that cross given boundaries: each maximal in the text, with the boundaries that it was found at. Periods come in rising order."""

    def __init__(self, word: np.ndarray):
        self.word = word
        self.runs: list[Interval] = []
        self.met: list[tuple[int, int]] = []
        self.near: dict[int, list[Interval]] = defaultdict(list)
        self.period, self.until = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)  # of the run that holds a word and ends last

    def search(self, text: np.ndarray, bounds: np.ndarray) -> Crossing:
        for candidates in (short_periods(self.word, bounds), long_periods(self.word, text, bounds)):
            for q, places in candidates:
                self.of_period(q, places[self.open(q, places - 1) | self.open(q, places - q)].tolist())
        return self

    def open(self, q: int, i: np.ndarray) -> np.ndarray:
        """Whether the words i and i + q are the same, and not as part of a run of a shorter period that divides `q`."""
        inside = (i >= 0) & (i + q < len(self.word))
        i = np.where(inside, i, 0)
        within = (self.until[i] > i + q) & (q % np.maximum(self.period[i], 1) == 0) & (self.period[i] < q)
        return inside & ~within & (self.word[i] == self.word[np.minimum(i + q, len(self.word) - 1)])

    def repeats(self, start: int, end: int, q: int, at: int) -> bool:
        """Whether the words from `start` to `end`, of period `q`, repeat with a shorter period: a run of a divisor of `q` that holds `q` of them says so."""
        return any(q % p == 0 and min(b, end) - max(a, start) >= q for a, b, p in self.near.get(at >> 6, ()))

    def of_period(self, q: int, places: list[int]) -> None:
        """`word[i] == word[i + q]` for i = m - 1 if the run has two periods behind the boundary m, for i = m - q if it has them ahead."""
        known: list[tuple[int, int, int]] = []
        for m in places:
            for i in (m - q, m - 1) if q > 1 else (m - 1,):
                if i < 0 or i + q >= len(self.word) or self.word[i] != self.word[i + q]:
                    continue
                run = next((k for k in known if k[0] <= i and i + q < k[1]), None)
                if run is None:
                    if self.repeats(i, i + q + 1, q, i):
                        continue
                    start, end = i - agree(self.word, i, i + q, back=True), i + q + agree(self.word, i, i + q, back=False)
                    run = (start, end, self.add(start, end, q, m))
                    known = [run, *known[:3]]
                if run[2] >= 0 and run[0] < m < run[1]:
                    self.met.append((m, run[2]))

    def add(self, start: int, end: int, q: int, at: int) -> int:
        """Number of the run, -1 if it is too short or has a shorter period."""
        if not long_enough(end - start, q) or self.repeats(start, end, q, at):
            return -1
        self.runs.append((start, end, q))
        later = np.flatnonzero(self.until[start:end] < end) + start
        self.period[later], self.until[later] = q, end
        for block in range(start >> 6, (end >> 6) + 1):
            self.near[block].append((start, end, q))
        return len(self.runs) - 1


def all_runs(word: np.ndarray, text: np.ndarray) -> list[Interval]:
    """(start, end, period) of all runs, sorted. `word`: numbers of the words of texts end to end; a text ends with a number of its own below zero."""
    inside = np.flatnonzero(word >= 0)
    if not len(inside):
        return []
    grammar = Grammar(word[inside], inside, text[inside])
    is_bound = np.zeros(len(word) + 1, bool)
    is_bound[1:len(word)] = (word[1:] >= 0) & (word[:-1] >= 0)
    is_bound[grammar.middle[~grammar.first]] = False
    crossing = Crossing(word).search(text, np.flatnonzero(is_bound))
    heads = np.flatnonzero(grammar.first)
    until = np.append(heads[1:], len(grammar.rule))
    rule_at = dict(zip(grammar.middle[heads].tolist(), zip(heads.tolist(), until.tolist()))) if crossing.met else {}
    found = defaultdict(set)
    for a, b, q in crossing.runs:
        found[q].add((a, b))
    for m, number in crossing.met:
        if m in rule_at:
            head, end = rule_at[m]
            a, b, q = crossing.runs[number]
            a, b = max(a, int(grammar.start[head])), min(b, int(grammar.end[head]))
            if long_enough(b - a, q):
                found[q].update((a + s, b + s) for s in (grammar.start[head + 1:end] - grammar.start[head]).tolist())
    return sorted(merged(found))


def merged(found: dict[int, set[tuple[int, int]]]) -> Iterator[Interval]:
    """Stretches of one period that share a period's length of words are one."""
    for q, parts in found.items():
        start = end = None
        for a, b in sorted(parts):
            if end is not None and a + q <= end:
                end = max(end, b)
            else:
                if end is not None:
                    yield start, end, q
                start, end = a, b
        if end is not None:
            yield start, end, q


def step(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each row."""
    data, offsets = text_bytes(column)
    ink, starts, ends, bounds = spans(data, offsets)
    rows, n = len(column), len(starts)
    lengths = ends - starts
    letters, ends_of = np.ascontiguousarray(data[ink]), np.concatenate([[0], np.cumsum(lengths)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends_of.astype(np.int64)), pa.py_buffer(letters)])
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of = row_of(bounds)
    place = np.arange(n) + of
    word, text = np.empty(n + rows, np.int64), np.empty(n + rows, np.int64)
    word[place], text[place] = ids, of
    closing = bounds[1:] + np.arange(rows)
    word[closing], text[closing] = -1 - np.arange(rows), np.arange(rows)
    found = all_runs(word, text)
    begin = bounds[:-1] + np.arange(rows)
    runs: list[list[dict]] = [[] for _ in range(rows)]
    change = np.zeros(n + rows + 1, np.int64)
    for a, b, q in found:
        row = int(text[a])
        runs[row].append({"start": a - int(begin[row]), "length": b - a, "period": q})
        change[a + q] += 1
        change[b] -= 1
    kept = np.cumsum(change)[:-1][place] == 0
    spaced = np.full(len(letters) + n, 32, np.uint8)
    spaced[np.arange(ends_of[-1]) + np.repeat(np.arange(n), lengths)] = letters
    size = np.where(kept, lengths + 1, 0)
    stays = np.repeat(kept, lengths + 1)
    last = np.full(rows, -1)
    last[of[kept]] = np.flatnonzero(kept)
    last = last[last >= 0]
    stays[(ends_of[1:] + np.arange(n))[last]] = False
    size[last] -= 1
    text_ends = np.concatenate([[0], np.cumsum(size)])[bounds]
    collapsed = pa.StringArray.from_buffers(rows, pa.py_buffer(text_ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(spaced[stays])))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return pa.array(runs, kind), collapsed


def collapse(texts: DataFrame) -> DataFrame:
    """doc_id, runs, collapsed: one row per row of `texts` (doc_id, text).

    `runs` are (start, length, period) by start, then period; words count from 0 and are what lies between white space. A run is a longest stretch of words that repeats
    with a smallest period, four periods and six words long at least. `collapsed` are the words, joined by single spaces, less those that a run holds after its
    first period. A null text has no words, no runs and an empty collapsed text; repeated rows and null ids are rows like any other; an empty table gives an empty
    result; other columns are ignored. Texts are taken a megabyte at a time, a longer one alone; no row leaves its task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                runs, collapsed = step(part.column("text"))
                yield pa.record_batch({"doc_id": part.column("doc_id"), "runs": runs, "collapsed": collapsed})

    plain = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, f"doc_id bigint, runs {RUNS}, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The text with the repetitions that the query's contract puts into a tenth of all documents, by the checksum of their id."""
    words = F.regexp_extract_all(text, F.lit(f"([^{SPACES}]+)"))
    name = F.crc32(doc_id.cast("string").cast("binary"))

    def repeat(words: Column) -> Column:
        n, g = F.size(words).cast("long"), F.floor(name / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        again = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, (a + (i - a) % p).cast("int")))
        return F.array_join(F.concat(F.slice(words, 1, a.cast("int")), again), " ")

    some = (name % 10 == 0) & text.rlike(f"[^{SPACES}]")
    return F.when(some, F.get(F.transform(F.array(words), repeat), 0)).otherwise(text)


def run_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 of the planted texts, and the runs themselves."""
    texts = docs.select("doc_id", planted(F.col("doc_id"), F.col("text").cast("string")).alias("text"))

    def before(x: Column, y: Column) -> Column:
        more = y["length"] * x["period"] - x["length"] * y["period"]
        order = F.when(more != 0, F.signum(more)).when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(x["period"] - y["period"]))
        return order.cast("int")

    found = collapse(texts).withColumn("best", F.get(F.array_sort("runs", before), 0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "runs",
    )
