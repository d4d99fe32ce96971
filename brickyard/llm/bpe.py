"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes cuts every text into chunks whose ends depend on the bytes near them only, so passages that documents share fall into equal
chunks wherever they stand. A chunk is encoded once per worker and then taken from a bounded store. The joins of chunks are repaired: the stretch around a
cut is widened to both sides until it ends where encoding it alone must agree with encoding the whole text, which for a tokenizer that drops white
space is the nearest white space, and is encoded anew; if a chunk has no such place, the stretch runs on into the next chunk.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brickyard.llm.common import _BYTE, ragged, spans, steps, text_bytes, word_hashes

#: A chunk ends where this many low bits of the rolling hash are zero: 512 bytes on average.
CUT_BITS = 9
#: Bytes that the rolling hash sees.
WINDOW = 16
#: Bytes of text that are encoded together.
TOGETHER = 1 << 18
#: Entries of a worker's two stores. A full store starts anew: what it held is encoded again; results don't depend on it.
CHUNKS, WORDS = 4_000, 300_000
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Words for which Python's normalisation is surely the tokenizer's: ASCII and composed Latin letters.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e]+")
#: Fixed value: the tokenizer's own split pattern, over the characters of PLAIN.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017e]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017e]+")
END = "</w>"

Coded = tuple[bytes, bytes]


class Words:
    """Encoded words by their exact bytes, as the tokenizer isn't blind to case everywhere: sorted hashes that lead to a place, where a word's bytes are compared, and
    the bytes, ids and decoded bytes of all words end to end (about 50 bytes a word)."""

    def __init__(self):
        self.keys, self.place = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.raw, self.raw_ends = np.empty(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.ends = np.empty(0, "<u4"), np.zeros(1, np.int64)
        self.text, self.text_ends = np.empty(0, np.uint8), np.zeros(1, np.int64)

    def find(self, keys: np.ndarray, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place of each word of `raw`, -1 if it isn't there: a hash that another word has doesn't count."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        place, lengths = self.place[at], np.diff(ends)
        same = (self.keys[at] == keys) & (self.raw_ends[place + 1] - self.raw_ends[place] == lengths)
        rows = np.flatnonzero(same)
        differ = self.raw[ragged(self.raw_ends[place[rows]], lengths[rows])] != raw[ragged(ends[rows], lengths[rows])]
        same[np.repeat(rows, lengths[rows])[differ]] = False
        return np.where(same, place, -1)

    def add(self, keys: np.ndarray, words: list[bytes], coded: list[Coded]) -> np.ndarray:
        """Places of new words. A word whose hash is taken is found no more, and encoded anew when it comes again."""
        places = np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(words))
        fresh, first = np.unique(keys, return_index=True)
        at = np.searchsorted(self.keys, fresh)
        free = np.ones(len(fresh), bool)
        inside = at < len(self.keys)
        free[inside] = self.keys[at[inside]] != fresh[inside]
        self.keys, self.place = np.insert(self.keys, at[free], fresh[free]), np.insert(self.place, at[free], places[first[free]])
        for parts, flat, ends, kind in ((words, "raw", "raw_ends", np.uint8), ([c[0] for c in coded], "ids", "ends", "<u4"), ([c[1] for c in coded], "text", "text_ends", np.uint8)):
            lengths = np.array(list(map(len, parts)), np.int64) // np.dtype(kind).itemsize
            setattr(self, flat, np.concatenate([getattr(self, flat), np.frombuffer(b"".join(parts), kind)]))
            setattr(self, ends, np.concatenate([getattr(self, ends), getattr(self, ends)[-1] + np.cumsum(lengths)]))
        return places


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where chunks end, from a hash over the `WINDOW` bytes before each; none within the first bytes of a text."""
    h = (_BYTE[data] >> np.uint64(20)).astype(np.uint32)
    span = 1
    while span < WINDOW:
        h[span:] += h[:-span] * np.uint32(pow(0x01000193, span, 1 << 32))
        span *= 2
    h ^= h >> np.uint32(15)
    found = np.flatnonzero((h & np.uint32((1 << CUT_BITS) - 1)) == 0) + 1
    start = offsets[np.searchsorted(offsets, found - 1, side="right") - 1]
    return found[found - start >= WINDOW]


class Encoder:
    """Ids and decoded text of whole texts; one per Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, self.split = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for tokenizer in (self.whole, self.split):
            tokenizer.no_padding()
            tokenizer.no_truncation()
        apart = [i for w in ("ab", "cd") for i in self.whole.encode(w, add_special_tokens=False).ids]
        if self.whole.encode(" ab\x0b\x0c\r\t\ncd ", add_special_tokens=False).ids != apart or self.whole.decoder is not None:
            raise ValueError("joins are repaired at white space, which this tokenizer doesn't drop")
        self.split.normalizer = normalizers.Sequence([])
        self.split.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        names = [self.whole.id_to_token(i) or "" for i in range(self.whole.get_vocab_size())]
        self.tokens, self.last = [t.encode() + b" " for t in names], np.array([t.endswith(END) for t in names])
        self.words, self.chunks = Words(), {}

    def coded(self, ids: list[int]) -> Coded:
        return struct.pack(f"<{len(ids)}I", *ids), b"".join([self.tokens[i] for i in ids])

    def encode_words(self, missing: list[bytes]) -> list[Coded]:
        """Words without white space. Plain ones go to the tokenizer many at a time, split as its pattern splits them; its end-of-word tokens tell them apart."""
        texts = [w.decode() for w in missing]
        plain = [PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        rest = [w for w, p in zip(missing, plain, strict=True) if not p]
        out = dict(zip(rest, map(self.coded, (e.ids for e in self.whole.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False))), strict=True))
        words = [w for w, p in zip(missing, plain, strict=True) if p]
        lower = [t.lower() for t, p in zip(texts, plain, strict=True) if p]
        pieces = [t if t.isalpha() else PIECES.findall(t) for t in lower]
        counts = [1 if type(p) is str else len(p) for p in pieces]
        lines = [" ".join([p if type(p) is str else " ".join(p) for p in pieces[at:at + 500]]) for at in range(0, len(words), 500)]
        ids = list(itertools.chain.from_iterable(e.ids for e in self.split.encode_batch_fast(lines, add_special_tokens=False)))
        ends = (np.flatnonzero(self.last[np.array(ids, np.int64)]) + 1).tolist() if ids else []
        if len(ends) != sum(counts):
            raise ValueError("a piece of a word doesn't end with an end-of-word token")
        raw, tokens = np.array(ids, "<u4").tobytes(), list(map(self.tokens.__getitem__, ids))
        place = 0
        for w, k in zip(words, itertools.accumulate(counts), strict=True):
            end = ends[k - 1]
            out[w] = raw[4 * place:4 * end], b"".join(tokens[place:end])
            place = end
        return [out[w] for w in missing]

    def encode_stretches(self, stretches: list[bytes]) -> list[Coded]:
        """Stretches that white space or an end of the text bounds on both sides. Each word that isn't in the store is encoded once for all of them."""
        data = np.frombuffer(b"".join(stretches), np.uint8)
        offsets = np.cumsum([0, *map(len, stretches)])
        ink, starts, ends, marks = spans(data, offsets)
        if not len(starts):
            return [(b"", b"")] * len(stretches)
        bounds = np.concatenate([[0], np.cumsum(ends - starts)])
        every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[ink]))])
        coded = every.dictionary_encode()
        which, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        raw, bounds = np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)])
        keys = word_hashes(raw, bounds[:-1], np.diff(bounds))
        if len(self.words.ends) > WORDS:
            self.words = Words()
        place = self.words.find(keys, raw, bounds)
        new = np.flatnonzero(place < 0)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            place[new] = self.words.add(keys[new], fresh, self.encode_words(fresh))
        store, place = self.words, place[which]
        out = []
        for values, stops, wide in ((store.ids, store.ends, 4), (store.text, store.text_ends, 1)):
            lengths = stops[place + 1] - stops[place]
            raw = values[ragged(stops[place], lengths)].tobytes()
            edges = (np.concatenate([[0], np.cumsum(lengths)])[marks] * wide).tolist()
            out.append([raw[a:b] for a, b in itertools.pairwise(edges)])
        return list(zip(*out, strict=True))

    def documents(self, texts: list[bytes], ends: list[list[int]]) -> list[Coded]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text, of each text; `ends` are the cuts within it.

        A chunk's own part runs from its first to its last white space; the repaired stretch runs from one chunk's last white space over the cut, and over
        chunks without white space, to the next one's first.
        """
        pieces: list[list[bytes]] = []
        for text, inside in zip(texts, ends, strict=True):
            mine, open_at = [], 0
            for at, end in itertools.pairwise([0, *inside, len(text)]):
                low = SPACE.search(text, at, end)
                if low:
                    high = max(text.rfind(c, at, end) for c in EACH_SPACE)
                    mine += [text[open_at:low.start()], text[low.start():high + 1]]
                    open_at = high + 1
            pieces.append([*mine, text[open_at:]])
        if len(self.chunks) > CHUNKS:
            self.chunks = {}
        new = list({p for mine in pieces for p in mine[1::2]} - self.chunks.keys())
        coded = self.encode_stretches(new + [p for mine in pieces for p in mine[::2]])
        self.chunks.update(zip(new, coded, strict=False))
        repaired, out = iter(coded[len(new):]), []
        for mine in pieces:
            found = [next(repaired) if i % 2 == 0 else self.chunks[p] for i, p in enumerate(mine)]
            out.append((b"".join([x[0] for x in found]), b"".join([x[1] for x in found])[:-1]))
        return out


EACH_SPACE = (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c")
_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded_texts(batch: pa.RecordBatch, path: str) -> Iterator[tuple[pa.RecordBatch, list[tuple[bytes, bytes]]]]:
    """Parts of a batch with (ids, decoded text) of each row; a null text counts as empty."""
    own = encoder(path)
    for part in steps(batch, "text", TOGETHER):
        data, offsets = text_bytes(part.column("text"))
        raw, ends = data.tobytes(), cuts(data, offsets)
        first, last = np.searchsorted(ends, offsets[:-1], side="right"), np.searchsorted(ends, offsets[1:])
        places = offsets.tolist()
        inside = [(ends[i:j] - a).tolist() for i, j, a in zip(first, last, places, strict=False)]
        yield part, own.documents([raw[a:b] for a, b in itertools.pairwise(places)], inside)


def digests(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in encoded_texts(batch, path):
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(i) // 4 for i, _ in found], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i, _ in found]), pa.array([hashlib.sha256(d).hexdigest() for _, d in found]),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: one row per row of `docs`; see `encode` for the ids and texts themselves."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int>, decoded string: one row per row of `docs`, in place, with no shuffle.

    Whole texts; a null or empty text has no ids. Repeated rows give repeated rows, an empty table an empty result; other columns are ignored. `path` names the
    tokenizer's file, which every executor must have. The tokenizer must drop white space and have no decoder of its own (checked on loading, and by tests
    against whole-text encoding).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in encoded_texts(batch, path):
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([np.frombuffer(i, "<u4").astype("int32") for i, _ in found], pa.list_(pa.int32())),
                    pa.array([d.decode() for _, d in found], pa.string()),
                ], ["doc_id", "ids", "decoded"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
