"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans in other spellings.

The network is trained in numpy from labelled spans: what the base patterns find in a bounded sample of distinct texts, as it stands and respelt (brackets around dots
and at signs, the words "at" and "dot", other separators, no country code). It reads every stretch of a text near a digit, an at sign, a bracketed "at", or an "at" between spaces
whose next word goes on with a dot or with "dot"; other spellings of the four kinds (numbers in words, say) are not looked at. A stretch is covered by overlapping
windows; their emissions are blended with weights that fall towards a window's edges, and one Viterbi pass over the whole stretch reconciles them, so a span may cross
windows. Added spans must hold by the arithmetic of their kind and touch no base span.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard.llm.common import first_by_hash

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. A look-behind only spares starts that can't match; it changes no result.
EMAIL_AT = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NOT_DIGIT = re.compile(r"[^0-9]+")

#: Where the network looks, and how far around.
SEED = re.compile(r"[0-9@]|[(\[]\x20?at\x20?[)\]]|\x20at\x20(?=\S+(?:\x20dot\x20|\.)\S)", re.I)
REACH = 48
WIDTH, STRIDE = 96, 48
#: The fit reads at most this many distinct texts of each kind, and as many that are near no kind; none longer than this.
SAMPLE_DOCS, SAMPLE_CHARS = 100, 20_000
#: Loose forms of the base patterns, by which the sample is dealt into kinds.
LOOSE = {"email": "@[A-Za-z0-9-]+[.]", "ip": "[0-9][.][0-9]+[.][0-9]+[.][0-9]", "card": "[0-9]([ -]?[0-9]){12}", "phone": "[+][0-9][ ().0-9-]{7}"}
SYMBOLS, EMBED, HIDDEN, STEPS, BATCH, RATE = 130, 12, 20, 500, 48, 0.02
TAGS = 1 + 2 * len(KINDS)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def part_ok(part: str) -> bool:
    """At most 255; leading zeros and digit strings of any length are fine."""
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def emails(text: str) -> Iterator[Span]:
    """Leftmost non-overlapping matches. All starts in one run of local characters match or fail together, so only the run's start is tried."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = EMAIL_AT.match(text, start) if start < at else None
        if found:
            yield "email", start, found.end()
            done = found.end()
        else:
            done = at
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by kind as listed, then start."""
    out = list(emails(text))
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(map(part_ok, m.group().split(".")))]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def holds(kind: str, text: str) -> bool:
    """Whether a span in another spelling can be of its kind."""
    digits = NOT_DIGIT.sub("", text)
    if kind == "email":
        plain = re.sub(r"\s*[(\[]\s*(at|dot)\s*[)\]]\s*|\s(at|dot)\s", lambda m: "@" if (m[1] or m[2]).lower() == "at" else ".", text, flags=re.I)
        return EMAIL_AT.fullmatch(plain) is not None
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(map(part_ok, parts)) and re.fullmatch(r"[0-9]+(\s?[\[(]?\.[\])]?\s?[0-9]+){3}", text) is not None
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9]+([\x20./_-]{1,3}[0-9]+)*", text) is not None
    return 9 <= len(digits) <= 15 and re.fullmatch(r"[+(]?[0-9][\x20().0-9/-]*[0-9]", text) is not None and re.search(r"[\x20()./-]", text) is not None


def stretches(text: str) -> list[tuple[int, int]]:
    """Merged neighbourhoods of all seeds."""
    out: list[tuple[int, int]] = []
    for m in SEED.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, codes + 1, 129).astype(np.int64)


@dataclass
class Tagger:
    """Parameters by name: `e` embeddings; `wf`, `bf`, `wb`, `bb` gates of the two directions; `wo`, `bo` output; `t` transitions."""

    p: dict[str, np.ndarray]


def new_tagger(seed: int = 7) -> Tagger:
    random = np.random.default_rng(seed)
    p = {"e": random.normal(0, 0.3, (SYMBOLS, EMBED)), "wo": random.normal(0, 0.2, (2 * HIDDEN, TAGS)), "bo": np.zeros(TAGS), "t": np.zeros((TAGS, TAGS))}
    for d in "fb":
        p["w" + d], p["b" + d] = random.normal(0, 0.25, (EMBED + HIDDEN, 4 * HIDDEN)), np.zeros(4 * HIDDEN)
        p["b" + d][HIDDEN:2 * HIDDEN] = 1
    return Tagger({k: v.astype(np.float32) for k, v in p.items()})


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def lstm(x: np.ndarray, w: np.ndarray, b: np.ndarray, keep: list | None = None) -> np.ndarray:
    """x: time, batch, EMBED. `keep` collects what the way back needs."""
    h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
    out = np.empty((len(x), x.shape[1], HIDDEN), np.float32)
    inner = x @ w[:EMBED] + b
    for i in range(len(x)):
        z = inner[i] + h @ w[EMBED:]
        gates, new = sigmoid(z[:, :3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
        before, ahead = c, h
        c = gates[:, HIDDEN:2 * HIDDEN] * c + gates[:, :HIDDEN] * new
        flat = np.tanh(c)
        h = gates[:, 2 * HIDDEN:] * flat
        out[i] = h
        if keep is not None:
            keep.append((gates, new, before, flat, ahead))
    return out


def lstm_back(x: np.ndarray, w: np.ndarray, kept: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    dz = np.empty((len(x), x.shape[1], 4 * HIDDEN), np.float32)
    dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
    dw = np.zeros_like(w)
    for i in range(len(x) - 1, -1, -1):
        gates, new, before, flat, ahead = kept[i]
        a, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        dh = dh + dout[i]
        dc = dc + dh * o * (1 - flat * flat)
        dz[i] = np.concatenate([dc * new * a * (1 - a), dc * before * f * (1 - f), dh * flat * o * (1 - o), dc * a * (1 - new * new)], axis=1)
        dw[EMBED:] += ahead.T @ dz[i]
        dh, dc = dz[i] @ w[EMBED:].T, dc * f
    dw[:EMBED] = np.einsum("tbe,tbg->eg", x, dz, optimize=True)
    return dz @ w[:EMBED].T, dw, dz.sum(axis=(0, 1))


def emissions(tagger: Tagger, codes: np.ndarray) -> np.ndarray:
    """codes: batch, time. Result: batch, time, TAGS."""
    p, x = tagger.p, tagger.p["e"][codes.T]
    both = np.concatenate([lstm(x, p["wf"], p["bf"]), lstm(x[::-1], p["wb"], p["bb"])[::-1]], axis=2)
    return (both @ p["wo"] + p["bo"]).transpose(1, 0, 2)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def gradient(tagger: Tagger, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Negative log likelihood of the tags per row, and its gradient. codes, tags: batch, time."""
    p, (n, steps) = tagger.p, codes.shape
    x, kept = p["e"][codes.T], {"f": [], "b": []}
    hf, hb = lstm(x, p["wf"], p["bf"], kept["f"]), lstm(x[::-1], p["wb"], p["bb"], kept["b"])
    both = np.concatenate([hf, hb[::-1]], axis=2)
    z, t = both @ p["wo"] + p["bo"], p["t"]
    ahead, behind = np.empty_like(z), np.zeros_like(z)
    ahead[0] = z[0]
    for i in range(1, steps):
        ahead[i] = log_sum(ahead[i - 1][:, :, None] + t, 1) + z[i]
    for i in range(steps - 2, -1, -1):
        behind[i] = log_sum(t[None] + (z[i + 1] + behind[i + 1])[:, None, :], 2)
    total = log_sum(ahead[-1], 1)
    dz = np.exp(ahead + behind - total[None, :, None])
    pairs = np.exp(ahead[:-1][:, :, :, None] + t + (z[1:] + behind[1:])[:, :, None, :] - total[None, :, None, None]).sum(axis=(0, 1))
    row, when = np.arange(n)[None, :], np.arange(steps)[:, None]
    score = z[when, row, tags.T].sum() + t[tags[:, :-1], tags[:, 1:]].sum()
    dz[when, row, tags.T] -= 1
    np.subtract.at(pairs, (tags[:, :-1], tags[:, 1:]), 1)
    g = {"t": pairs / n, "wo": np.einsum("tbh,tbk->hk", both, dz, optimize=True) / n, "bo": dz.sum(axis=(0, 1)) / n}
    dboth = (dz @ p["wo"].T / n).astype(np.float32)
    dxf, g["wf"], g["bf"] = lstm_back(x, p["wf"], kept["f"], dboth[:, :, :HIDDEN])
    dxb, g["wb"], g["bb"] = lstm_back(x[::-1], p["wb"], kept["b"], dboth[::-1, :, HIDDEN:])
    g["e"] = np.zeros_like(p["e"])
    np.add.at(g["e"], codes.T, dxf + dxb[::-1])
    return float((total.sum() - score) / n), g


def respelt(kind: str, text: str, random: np.random.Generator) -> str:
    """A labelled span in another spelling."""
    if kind == "email":
        at = ["(at)", "[at]", " (at) ", " [at] ", " at "][random.integers(5)]
        name, host = text.split("@", 1)
        return name + at + (host.replace(".", " dot " if at == " at " else "[dot]") if random.random() < 0.3 else host)
    if kind == "ip":
        return text.replace(".", ["[.]", "(.)", " . "][random.integers(3)])
    if kind == "card":
        digits, mark = NOT_DIGIT.sub("", text), [".", "/", "_", " - "][random.integers(4)]
        return mark.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    return re.sub(r"^\+[0-9]{1,2}[\x20.-]?", "", text)


def examples(texts: list[str], random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Windows with their tags: stretches as they stand, and with their spans respelt. 0 is nothing, 1 + 2k a span's start, 2 + 2k the rest of it."""
    codes, tags = [], []
    for text in texts:
        spans = sorted(base_spans(text), key=lambda s: (s[1], -s[2]))
        for a, b in stretches(text):
            own, end = [], a
            for kind, s, e in spans:
                if s >= end and e <= b:
                    own.append((kind, s, e))
                    end = e
            for change in (False, True) if own else (False,):
                out, marks, at = [], [], a
                for kind, s, e in own:
                    piece = respelt(kind, text[s:e], random) if change else text[s:e]
                    if change and not holds(kind, piece):
                        piece = text[s:e]
                    out += [text[at:s], piece]
                    k = 1 + 2 * KINDS.index(kind)
                    marks += [0] * (s - at) + [k] + [k + 1] * (len(piece) - 1)
                    at = e
                out.append(text[at:b])
                marks += [0] * (b - at)
                line = np.concatenate([symbols("".join(out)), np.zeros(WIDTH, np.int64)])
                mark = np.concatenate([np.array(marks, np.int64), np.zeros(WIDTH, np.int64)])
                for at in range(0, max(1, len(marks) - STRIDE), STRIDE):
                    codes.append(line[at:at + WIDTH])
                    tags.append(mark[at:at + WIDTH])
    return np.array(codes).reshape(-1, WIDTH), np.array(tags).reshape(-1, WIDTH)


def train(texts: list[str], seed: int = 7) -> Tagger | None:
    """Adam over random batches of windows; None when the texts hold no labelled span."""
    random = np.random.default_rng(seed)
    codes, tags = examples(texts, random)
    if not len(codes) or not tags.any():
        return None
    tagger = new_tagger(seed)
    first = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    for step in range(1, STEPS + 1):
        some = random.integers(0, len(codes), BATCH)
        _, g = gradient(tagger, codes[some], tags[some])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = RATE * (1 - 0.9 * step / STEPS)
        for k, v in g.items():
            v = v * min(1.0, 5.0 / (norm + 1e-9))
            first[k] += 0.1 * (v - first[k])
            second[k] += 0.01 * (v * v - second[k])
            tagger.p[k] = (tagger.p[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return tagger


def viterbi(scores: np.ndarray, lengths: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Best tags. scores: batch, time, TAGS; rows are as long as `lengths` says."""
    n, steps, _ = scores.shape
    best, back = scores[:, 0].copy(), np.zeros((steps, n, TAGS), np.int8)
    for i in range(1, steps):
        through = best[:, :, None] + t
        back[i] = through.argmax(axis=1)
        best = np.where((i < lengths)[:, None], through.max(axis=1) + scores[:, i], best)
    tags = np.zeros((n, steps), np.int8)
    now = best.argmax(axis=1)
    for i in range(steps - 1, -1, -1):
        tags[:, i] = np.where(i < lengths, now, 0)
        now = np.where((i < lengths) & (i > 0), back[i][np.arange(n), now], now)
    return tags


def tag(tagger: Tagger, lines: list[np.ndarray]) -> list[np.ndarray]:
    """Tags of whole stretches: blended emissions of overlapping windows, one Viterbi pass per stretch."""
    plan = [(k, at) for k, line in enumerate(lines) for at in range(0, max(1, len(line) - STRIDE), STRIDE)]
    weight = 1 + np.minimum(np.arange(WIDTH), np.arange(WIDTH)[::-1]).astype(np.float32)
    sums = [np.zeros((len(line), TAGS), np.float32) for line in lines]
    shares = [np.zeros((len(line), 1), np.float32) for line in lines]
    for some in itertools.batched(plan, 512):
        codes = np.zeros((len(some), WIDTH), np.int64)
        for r, (k, at) in enumerate(some):
            piece = lines[k][at:at + WIDTH]
            codes[r, :len(piece)] = piece
        for (k, at), z in zip(some, emissions(tagger, codes), strict=True):
            n = min(WIDTH, len(lines[k]) - at)
            sums[k][at:at + n] += z[:n] * weight[:n, None]
            shares[k][at:at + n] += weight[:n, None]
    out: list[np.ndarray] = [np.empty(0, np.int8)] * len(lines)
    order = sorted(range(len(lines)), key=lambda k: len(lines[k]))
    while order:
        some = [order.pop()]
        while order and len(some) < 256 and 2 * len(lines[order[-1]]) >= len(lines[some[0]]) and (len(some) + 1) * len(lines[some[0]]) < 200_000:
            some.append(order.pop())
        lengths = np.array([len(lines[k]) for k in some])
        scores = np.zeros((len(some), lengths.max(), TAGS), np.float32)
        for r, k in enumerate(some):
            scores[r, :len(lines[k])] = sums[k] / shares[k]
        for r, (k, tags) in enumerate(zip(some, viterbi(scores, lengths, tagger.p["t"]), strict=True)):
            out[k] = tags[:lengths[r]]
    return out


def added_spans(text: str, base: list[Span], places: list[tuple[int, int]], tags: list[np.ndarray]) -> list[Span]:
    """Spans that the network finds beside the base ones."""
    out: list[Span] = []
    taken = sorted((s, e) for _, s, e in base)
    for (a, _), line in zip(places, tags, strict=True):
        if not line.any():
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (line + 1) // 2, [0]])) | np.concatenate([(line % 2 == 1) & (line > 0), [False]]))
        for s, e in itertools.pairwise(edges.tolist()):
            if line[s]:
                kind, s, e = KINDS[(int(line[s]) - 1) // 2], a + s, a + e
                piece = text[s:e]
                s, e = s + len(piece) - len(piece.lstrip()), e - (len(piece) - len(piece.rstrip()))
                if e > s and holds(kind, text[s:e]) and not any(x < e and y > s for x, y in taken):
                    edge = (s == 0 or not text[s - 1].isalnum()) and (e == len(text) or not text[e].isalnum())
                    if edge:
                        out.append((kind, s, e))
    return out


def find_all(tagger: Tagger | None, texts: list[str | None]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, by kind as listed, then start."""
    filled = [t or "" for t in texts]
    base = [base_spans(t) if SEED.search(t) else [] for t in filled]
    places = [stretches(t) if tagger else [] for t in filled]
    tags = iter(tag(tagger, [symbols(t[a:b]) for t, p in zip(filled, places, strict=True) for a, b in p]) if tagger else [])
    out = []
    for text, own, where in zip(filled, base, places, strict=True):
        more = added_spans(text, own, where, [next(tags) for _ in where])
        out.append((own, sorted({*own, *more}, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def fit(docs: DataFrame, seed: int = 13) -> Tagger | None:
    """A tagger from the spans of a bounded sample: per kind, and for texts near no kind, the first `SAMPLE_DOCS` distinct texts by a seeded hash.

    Copies of a text count once. A kind's texts are found by a loose form of its pattern; the spans themselves come from the exact ones.
    """
    text = F.col("text").cast("string")
    usable = docs.select(text.alias("text")).where(F.col("text").rlike("[0-9@]") & (F.length("text") <= SAMPLE_CHARS))
    near = F.array_compact(F.array(*[F.when(F.col("text").rlike(pattern), F.lit(kind)) for kind, pattern in LOOSE.items()]))
    strata = F.explode(F.when(F.size(near) > 0, near).otherwise(F.array(F.lit("none")))).alias("stratum")
    rows = first_by_hash(usable.select(strata, F.xxhash64(F.lit(seed), "text").alias("h"), "text"), SAMPLE_DOCS)
    return train([t for _, t in sorted({(r["h"], r["text"]) for r in rows})])


def find(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """doc_id, text, base array, spans array (kind, start, end in code points, end exclusive): one row per row of `docs`, in place, with no shuffle.

    Whole texts of any length; null counts as empty and has no spans. Base spans always stay; repeated rows give repeated rows, an empty table an empty
    result; other columns are ignored. Without labelled spans to learn from, only the base spans are given.
    """
    return _spread(docs, tagger, "doc_id long, text string, base array<struct<kind: string, start: int, end: int>>, spans array<struct<kind: string, start: int, end: int>>", False)


def find_digests(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    return _spread(docs, tagger, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", True)


def _spread(docs: DataFrame, tagger: Tagger | None, schema: str, digest: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(tagger or fit(docs))
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find_all(sent.value, batch.column("text").to_pylist())
            if digest:
                counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS]
                hashes = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, hashes, pa.array([joined(s) for _, s in found], pa.string())],
                                                 ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
            else:
                lists = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in pair[i]] for pair in found], item) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), *lists], ["doc_id", "text", "base", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)
