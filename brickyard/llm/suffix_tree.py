"""Language-model scores from a probabilistic suffix tree over words.

States are contexts of up to two tokens. A context is a candidate when it has at least the share `P_CONTEXT` of all training tokens, and stays when its
next-token distribution diverges enough from that of its longest kept suffix (count times Kullback-Leibler divergence against a cutoff that grows with the
logarithm of the corpus). A state keeps counts of followers with at least the share `P_PAIR`; the rest of its mass is spread as its suffix spreads it:

    P(w | s) = (c(s, w) + rest(s) * P(w | suffix(s))) / (c(s) + K),    rest(s) = K + c(s) - sum of the kept counts

which sums to one. The root is the additive base distribution over all training tokens. As shares of contexts add up to one, a tree holds at most 1 / share contexts and
followers per length whatever the corpus: that is the bound of what is broadcast. Counts of all other tokens are joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard.llm.common import mix, row_of, steps, words
from brickyard.session import written

#: Least shares of the training tokens: of a word whose count is broadcast, of a context, of a context with its follower.
P_WORD, P_CONTEXT, P_PAIR = 5e-7, 5e-5, 1e-6
#: Pseudo-count of a state, and the cutoff of the divergence test as a multiple of log(N).
K, CUTOFF = 1.0, 2.0
#: Names of the two tokens that aren't words.
END, START = np.uint64(0), np.uint64(1)
#: Distinct keys that a task counts before it hands them on.
HELD = 1_000_000


@dataclass
class Tree:
    """`words` sorted; contexts and followers are codes of places in `words` (one place more stands for a text's start)."""

    total: int
    distinct: int
    words: np.ndarray
    counts: np.ndarray
    states: list[dict[str, np.ndarray]] = field(default_factory=list)

    @property
    def wide(self) -> int:
        return len(self.words) + 1

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.total + 0.1 * (self.distinct + 1)))


def find(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in sorted keys, -1 if it isn't there."""
    if not len(keys):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text and one end, and offsets."""
    hashes, marks = words(column)
    hashes = np.where(hashes < 2, hashes + np.uint64(2), hashes)
    offsets = marks + np.arange(len(marks))
    out = np.full(int(offsets[-1]), END)
    out[np.arange(len(hashes)) + row_of(marks)] = hashes
    return out, offsets


def places(tree: Tree, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of each token, of the one before it and of the one before that; -1 outside the words of the tree or ahead of the start."""
    now = find(tree.words, hashes)
    before = np.concatenate([[-1], now[:-1]])
    heads = offsets[:-1]
    before[heads] = len(tree.words)
    second = np.concatenate([[-1], before[:-1]])
    second[heads] = -1
    return now, before, second


def counted(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Counts of keys, summed inside the task as far as `HELD` distinct keys go."""
    keys, counts, n = [], [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        k, c = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(k, kind="stable")
        k, c = k[order], c[order]
        heads = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
        return k[heads], np.add.reduceat(c, heads) if len(heads) else c

    for part in parts:
        k, c = np.unique(part, return_counts=True)
        keys.append(k)
        counts.append(c)
        n += len(k)
        if n >= 2 * HELD:
            k, c = merged()
            if len(k) >= HELD:
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], ["k", "c"])
                keys, counts, n = [], [], 0
            else:
                keys, counts, n = [k], [c], len(k)
    if n:
        k, c = merged()
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], ["k", "c"])


def count_keys(texts: DataFrame, keys: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(k, c) over all tokens of `texts`; `keys` gives the 64-bit keys to count from tokens and offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from counted(keys(*tokens(part.column("text"))) for b in batches for part in steps(b, "text"))

    return texts.mapInArrow(run, "k long, c long").groupBy("k").agg(F.sum("c").alias("c"))


def arrow_columns(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(k, c) sorted by k; of a table with a proven bound."""
    table = rows.select("k", "c").toArrow()
    k, c = (table.column(x).to_numpy().astype(np.int64) for x in ("k", "c"))
    order = np.argsort(k.view(np.uint64))
    return k.view(np.uint64)[order], c[order]


def kept_states(tree: Tree, contexts: np.ndarray, totals: np.ndarray, pairs: np.ndarray, counts: np.ndarray, parents: np.ndarray) -> dict[str, np.ndarray]:
    """The contexts that pass the divergence test, with their followers. `pairs` = context place * wide + word place; `parents`: P(word | suffix) of each pair."""
    context = pairs // tree.wide
    mass = np.bincount(context, weights=counts, minlength=len(contexts))
    rest = K + totals - mass
    p = (counts + rest[context] * parents) / (totals[context] + K)
    spread = np.log(rest / (totals + K))
    known = np.bincount(context, weights=parents, minlength=len(contexts))
    gain = np.bincount(context, weights=p * np.log(p / parents), minlength=len(contexts)) + rest / (totals + K) * (1 - known) * spread
    stays = totals * gain >= CUTOFF * np.log(max(tree.total, 2))
    number = np.cumsum(stays) - 1
    own = stays[context]
    return {"contexts": contexts[stays], "spread": spread[stays] / np.log(10), "rest": rest[stays], "totals": totals[stays],
            "pairs": number[context[own]] * tree.wide + pairs[own] % tree.wide, "counts": counts[own]}


def context_of(tree: Tree, depth: int, before: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Code of the context of one or two tokens, -1 if there is none."""
    if depth == 0:
        return before
    return np.where((second >= 0) & (before >= 0), second * tree.wide + before, -1)


def change(tree: Tree, now: np.ndarray, before: np.ndarray, second: np.ndarray) -> np.ndarray:
    """log10 P(token | longest suffix state) - log10 P(token) of each position."""
    root = 10.0 ** tree.base(tree.counts[np.maximum(now, 0)].astype(float)) if len(tree.words) else np.zeros(len(now))
    out = np.zeros(len(now))
    for depth, state in enumerate(tree.states):
        place = find(state["contexts"], context_of(tree, depth, before, second))
        inside = np.flatnonzero(place >= 0)
        if not len(inside):
            continue
        s, w = place[inside], now[inside]
        pair = np.where(w >= 0, find(state["pairs"], s * tree.wide + w), -1)
        new = state["spread"][s] + out[inside]
        hit = np.flatnonzero(pair >= 0)
        p = root[inside[hit]] * 10.0 ** out[inside[hit]]
        new[hit] = np.log10((state["counts"][pair[hit]] + state["rest"][s[hit]] * p) / (state["totals"][s[hit]] + K)) - np.log10(root[inside[hit]])
        out[inside] = new
    return out


def grow(texts: DataFrame, counts: DataFrame, starts: int) -> Tree:
    """The tree of training texts from their token counts (k, c), in two more passes over the texts."""
    whole = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, distinct = int(whole["n"] or 0), int(whole["v"])
    least = lambda share: max(2, int(np.ceil(share * total)))
    tree = Tree(total, distinct, *arrow_columns(counts.where(F.col("c") >= least(P_WORD))))
    sent = texts.sparkSession.sparkContext.broadcast
    usable = np.append((tree.counts >= least(P_CONTEXT)) & (tree.words != END), starts >= least(P_CONTEXT))
    contexts = np.flatnonzero(usable)
    totals = np.append(tree.counts, starts)[contexts].astype(float)
    for depth in range(2):
        if not len(contexts):
            break
        shared = sent((tree, contexts))

        def keys(hashes: np.ndarray, offsets: np.ndarray, shared=shared, depth=depth) -> np.ndarray:
            own, candidates = shared.value
            now, before, second = places(own, hashes, offsets)
            place = find(candidates, context_of(own, depth, before, second))
            good = (place >= 0) & (now >= 0)
            return (place[good] * own.wide + now[good]).astype(np.uint64)

        pairs, found = arrow_columns(count_keys(texts, keys).where(F.col("c") >= least(P_PAIR)))
        pairs = pairs.astype(np.int64)
        word, context = pairs % tree.wide, contexts[pairs // tree.wide]
        before, second = (context, np.full(len(pairs), -1)) if depth == 0 else (context % tree.wide, context // tree.wide)
        parents = 10.0 ** (tree.base(tree.counts[word].astype(float)) + change(tree, word, before, second)) if len(pairs) else np.empty(0)
        tree.states.append(kept_states(tree, contexts, totals, pairs, found.astype(float), parents))
        often = (found >= least(P_CONTEXT)) & (word < len(tree.words)) & usable[word] if len(pairs) else np.empty(0, bool)
        codes, totals = context[often] * tree.wide + word[often], found[often].astype(float)
        order = np.argsort(codes)
        contexts, totals = codes[order], totals[order]
    return tree


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def read_texts(texts: DataFrame, tree: Tree) -> DataFrame:
    """One row per text with what the broadcast tree says, and one row per text and distinct rare word to be joined with its count."""
    sent = texts.sparkSession.sparkContext.broadcast(tree)
    names = ["k", "rid", "m", "doc_id", "held", "n_tokens", "known", "base", "extra"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for part in (p for b in batches for p in steps(b, "text")):
            hashes, offsets = tokens(part.column("text"))
            now, before, second = places(own, hashes, offsets)
            row, rid = row_of(offsets), part.column("rid").to_numpy()
            common = now >= 0
            base = np.where(common, own.base(own.counts[np.maximum(now, 0)].astype(float)), 0.0) if len(own.words) else np.zeros(len(now))
            sums = [np.add.reduceat(x, offsets[:-1]) for x in (common.astype(np.int64), base, change(own, now, before, second))]
            key = mix(rid.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)).view(np.int64)
            nothing = np.zeros(len(rid), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(rid), pa.array(nothing), part.column("doc_id"), part.column("held"), pa.array(np.diff(offsets)),
                                              *map(pa.array, sums)], names)
            rare = np.flatnonzero(~common)
            order = rare[np.lexsort((hashes[rare], row[rare]))]
            h, r = hashes[order], row[order]
            heads = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])) if len(h) else np.empty(0, np.int64)
            n = len(heads)
            yield pa.RecordBatch.from_arrays([pa.array(h[heads].view(np.int64)), pa.array(rid[r[heads]]), pa.array(np.diff(np.append(heads, len(h)))),
                                              pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), *(pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names)

    return texts.mapInArrow(run, "k long, rid long, m long, doc_id long, held boolean, n_tokens long, known long, base double, extra double")


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of `docs`.

    Tokens are the words of the lower-cased text (null: empty) and one end; learning reads the texts whose crc32(doc_id) mod 10 is not 0 (rows without an
    id are learnt). base_score is the additive unigram, score the suffix tree. Repeated rows count as often as they come; an empty table gives an empty result;
    other columns are ignored. No text is cut: a very long one only makes its own step longer.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held"))
    training = texts.where(~F.col("held"))
    counts = written(count_keys(training.select("text"), lambda hashes, offsets: hashes))
    starts = training.count()
    tree = grow(training.select("text"), counts, starts)
    rows = read_texts(texts.withColumn("rid", F.monotonically_increasing_id()), tree)
    joined = rows.join(counts, "k", "left")
    size = F.col("m") * F.log10((F.coalesce("c", F.lit(0)) + F.lit(0.1)) / F.lit(tree.total + 0.1 * (tree.distinct + 1)))
    known = F.when(F.col("m") > 0, F.when(F.col("c").isNotNull(), F.col("m")).otherwise(0)).otherwise(F.col("known"))
    base = F.when(F.col("m") > 0, size).otherwise(F.col("base"))
    out = joined.select("rid", "doc_id", "held", "n_tokens", known.alias("known"), base.alias("base"), "extra").groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("held").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("known").alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"), F.sum("base").alias("base_score"), F.max("extra").alias("extra"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", (F.col("base_score") + F.col("extra")).alias("score"))
