"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by stochastic gradient descent in numpy.

Features of a text are the byte 3-, 4- and 5-grams around every byte of its words (a space stands for a word's edge) and the words themselves, hashed into
one table of embeddings. Their mean goes through a linear softmax. A temperature and a rejection threshold are calibrated on rows that the fit didn't see.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard.llm.common import _SPACE, first_by_hash, row_of, steps, text_bytes, word_spans

#: The fit and the calibration together read at most this many labelled rows per language, the calibration every fourth; rows with longer texts are left to prediction.
SAMPLE_ROWS, SAMPLE_CHARS = 400, 50_000
#: Few rows are gone through more often than EPOCHS, until so many have been seen.
SEEN = 12_000
BUCKETS, WIDTH, EPOCHS, BATCH, RATE = 1 << 15, 10, 6, 16, 4.0
#: Share of calibration rows, with the right language on top, that the threshold may reject; and the threshold's ceiling.
MISSED, CEILING = 0.001, 0.5
#: Bytes of text that are predicted together: their features take some hundred times as much memory.
TOGETHER = 1 << 18
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    """`logits` per bucket is embedding times weights: the mean of a linear map is the linear map of the mean."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, and the row of each."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    lower = np.where((data >= 65) & (data <= 90), data | 32, data)
    ink = ~_SPACE[lower]
    lower = np.where(ink, lower, 32).astype(np.uint32)
    pad = np.full(len(lower) + 4, 32, np.uint32)
    pad[2:-2] = lower
    n = len(lower)
    same = np.ones((5, n), bool)
    for k, shift in enumerate((-2, -1, 1, 2)):
        other = np.full(n, -1, np.int32)
        if shift < 0:
            other[-shift:] = rows[:shift]
        else:
            other[:-shift] = rows[shift:]
        same[k] = other == rows
    left2, left, right, right2 = (np.where(same[k], pad[2 + s:2 + s + n], np.uint32(32)) for k, s in enumerate((-2, -1, 1, 2)))
    left2, right2 = np.where(left == 32, np.uint32(32), left2), np.where(right == 32, np.uint32(32), right2)
    three = (left * np.uint32(0x01000193) + lower) * np.uint32(0x01000193) + right
    four = (three * np.uint32(0x01000193) + right2) ^ np.uint32(0x9E3779B9)
    five = (four * np.uint32(0x01000193) + left2) ^ np.uint32(0x85EBCA6B)
    out = []
    for h in (three, four, five):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out.append(((h ^ (h >> np.uint32(13))) & np.uint32(BUCKETS - 1))[ink])
    hashes, _, _, marks = word_spans(data, offsets)
    out.append((hashes & np.uint64(BUCKETS - 1)).astype(np.uint32))
    return np.concatenate(out), np.concatenate([rows[ink]] * 3 + [row_of(marks)])


def tally(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their share, per text."""
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        buckets, _ = features(data[a:b], np.array([0, b - a]))
        seen, n = np.unique(buckets, return_counts=True)
        out.append((seen, n / max(1, n.sum())))
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def snippets(texts: list[str], labels: list[int], random: np.random.Generator) -> tuple[list[str], list[int]]:
    """The texts, and two stretches of 2 to 12 words of each, so that short texts are learnt and calibrated too."""
    more, names = list(texts), list(labels)
    for text, label in zip(texts, labels, strict=True):
        parts = text.split()
        for _ in range(2 if len(parts) > 4 else 0):
            n = int(random.integers(2, 13))
            at = int(random.integers(0, max(1, len(parts) - n)))
            more.append(" ".join(parts[at:at + n]))
            names.append(label)
    return more, names


def train(texts: list[str], labels: list[str], seed: int = 11) -> Model:
    """Stochastic gradient descent over small batches; the languages are the labels in their order."""
    languages = sorted(set(labels))
    random = np.random.default_rng(seed)
    number = {v: i for i, v in enumerate(languages)}
    texts, targets = snippets(texts, [number[x] for x in labels], random)
    rows = tally(texts)
    embedding = random.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH
    weights, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    usable = [i for i, (b, _) in enumerate(rows) if len(b)]
    epochs = max(EPOCHS, -(-SEEN // max(1, len(usable))))
    done, total = 0, epochs * max(1, len(usable))
    for _ in range(epochs):
        order = random.permutation(usable)
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            buckets, share = np.concatenate([rows[i][0] for i in some]), np.concatenate([rows[i][1] for i in some])[:, None]
            starts = np.cumsum([0, *(len(rows[i][0]) for i in some)])
            hidden = np.add.reduceat(embedding[buckets] * share, starts[:-1], axis=0)
            error = softmax(hidden @ weights + bias)
            error[np.arange(len(some)), [targets[i] for i in some]] -= 1
            rate = RATE * (1 - done / total) / len(some)
            back = error @ weights.T
            weights -= rate * hidden.T @ error
            bias -= rate * error.sum(axis=0)
            np.subtract.at(embedding, buckets, rate * BATCH * share * back[row_of(starts)])
            done += len(some)
    return Model(languages, (embedding @ weights).astype(np.float32), bias)


def logits(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean logits of each row; a row without features has the bias."""
    buckets, rows = features(data, offsets)
    n = np.bincount(rows, minlength=len(offsets) - 1)
    sums = [np.bincount(rows, weights=model.logits[:, k][buckets], minlength=len(offsets) - 1) for k in range(len(model.languages))]
    return np.stack(sums, axis=1) / np.maximum(n, 1)[:, None] + model.bias


def calibrate(model: Model, texts: list[str], labels: list[str], seed: int = 12) -> Model:
    """Temperature of the least log loss, then the threshold that rejects `MISSED` of the rightly recognised rows, `CEILING` at most."""
    known = [(t, model.languages.index(v)) for t, v in zip(texts, labels, strict=True) if v in model.languages and LETTER.search(t)]
    if not known:
        return model
    texts, targets = snippets([t for t, _ in known], [v for _, v in known], np.random.default_rng(seed))
    z = logits(model, *text_bytes(pa.array(texts, pa.large_string())))
    right = np.array(targets)
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 60))
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(right)), right], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = softmax(z / model.temperature)
    good = p.max(axis=1)[p.argmax(axis=1) == right]
    model.threshold = float(min(CEILING, np.quantile(good, MISSED))) if len(good) else 0.0
    return model


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, seed: int = 3) -> Model:
    """A model from documents with text and language outside the held-out third; the bounded sample is the first rows of each language by a seeded hash, rows equal in id and text once."""
    usable = docs.where(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    chosen = first_by_hash(usable.select(F.col("lang").cast("string").alias("stratum"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"), "text"), SAMPLE_ROWS)
    rows = []
    for _, same in itertools.groupby(chosen, key=lambda r: r["stratum"]):
        rows += [{"place": i, "lang": r["stratum"], "text": r["text"]} for i, r in enumerate(same, 1)]
    rows.sort(key=lambda r: (r["place"], r["lang"]))
    learn, check = [r for r in rows if r["place"] % 4], [r for r in rows if r["place"] % 4 == 0]
    if not learn:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    model = train([r["text"] for r in learn], [r["lang"] for r in learn])
    return calibrate(model, [r["text"] for r in check], [r["lang"] for r in check])


def answers(model: Model, column: pa.Array) -> tuple[list[str], list[float], list[bool]]:
    languages, scores, accepted = [], [], []
    for part in steps(pa.RecordBatch.from_arrays([column], ["text"]), "text", TOGETHER):
        texts = part.column("text").to_pylist()
        known = np.array([bool(model.languages) and t is not None and LETTER.search(t) is not None for t in texts], bool)
        if not known.any():
            languages += [UNKNOWN] * len(texts)
            scores += [0.0] * len(texts)
            accepted += [False] * len(texts)
            continue
        p = softmax(logits(model, *text_bytes(part.column("text"))) / model.temperature)
        best, top = p.argmax(axis=1), p.max(axis=1)
        languages += [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        scores += np.where(known, top, 0.0).tolist()
        accepted += (known & (top >= model.threshold)).tolist()
    return languages, scores, accepted


def predict(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """All columns of `docs` with lang_pred, score and accepted (the new columns replace ones of that name); rows stay in place, with no shuffle.

    lang_pred is a learned language, or `und` with score 0 when the text is null or has no letter (or when nothing could be learned). `accepted` is false
    for `und` and below the calibrated threshold. Only the text decides; whole texts of any length count. An empty table gives an empty result.
    """
    own = model or fit(docs)
    sent = docs.sparkSession.sparkContext.broadcast(own)

    @F.arrow_udf("struct<lang_pred: string, score: double, accepted: boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = answers(sent.value, batch)
            yield pa.StructArray.from_arrays([pa.array(found[0], pa.string()), pa.array(found[1], pa.float64()), pa.array(found[2], pa.bool_())],
                                             ["lang_pred", "score", "accepted"])

    out = docs.drop("lang_pred", "score", "accepted").withColumn("__found", run(F.col("text").cast("string")))
    return out.select("*", "__found.*").drop("__found")
