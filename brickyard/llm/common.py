"""Helpers shared by the operators: prefix sums without a global window, word hashes of Arrow text, links to components."""

from __future__ import annotations

import ctypes
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from brickyard.session import written

#: White space of the contracts: `[\x20\x09-\x0D]`.
SPACES = "\\x20\\x09-\\x0D"
#: Bytes of text that one step of numpy looks at (a longer text makes a step of its own).
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bits_for(rows: int) -> int:
    """Buckets as a power of two near the square root of the rows, so that neither a bucket nor the table of buckets grows as fast as the data."""
    return max(4, math.ceil(math.log2(max(rows, 1)) / 2))


def bucket_of(hashed: Column, bits: int) -> Column:
    """The highest bits of a 64-bit hash; it rises with the hash."""
    return F.shiftright(hashed, 64 - bits)


def before(counts: DataFrame, keys: list[str], order: str, amount: str, name: str) -> DataFrame:
    """Sum of `amount` over the buckets ahead of each one, per key."""
    ahead = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(amount).over(ahead), F.lit(0)).cast("long"))


def ranked(df: DataFrame, keys: list[str], bucket: str, order: list[Column | str], name: str) -> DataFrame:
    """Rank from 0 within `keys` (no nulls in them) in the order (bucket, *order).

    A key is cut into its buckets, each ranked alone, and a prefix sum over the small table of bucket counts
    joins them; a key with a third of all rows is thus spread over all tasks.
    """
    offsets = before(df.groupBy(*keys, bucket).agg(F.count("*").alias("__n")), keys, bucket, "__n", "__ahead").drop("__n")
    inner = Window.partitionBy(*keys, bucket).orderBy(*order)
    return (df.join(offsets, [*keys, bucket])
            .withColumn(name, F.row_number().over(inner) - 1 + F.col("__ahead")).drop("__ahead"))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A number per byte, the same for both cases of A-Z.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Words of more bytes are hashed one by one.
LONG_WORD = 256
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of words in a byte array: eight bytes at a time, each time through a finalizer, so that no sum of letters makes two words alike. Other seeds give
    independent hashes. Long words take a cryptographic hash."""
    wide = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    hashes = mix((lengths.astype(np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15))
    rows, at = np.flatnonzero(lengths <= LONG_WORD), 0
    while len(rows):
        left = lengths[rows] - at
        hashes[rows] = mix((hashes[rows] ^ (wide[starts[rows] + at] & _MASKS[np.minimum(left, 8)])) * np.uint64(0xD6E8FEB86659FD93))
        rows, at = rows[left > 8], at + 8
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i]:starts[i] + lengths[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column's rows, end to end, and the len+1 offsets; null is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset:]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Returns what the worker has freed to the system, which a waiting worker would keep otherwise."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `limit` bytes of text each; no row is cut. Freed memory goes back after each batch."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    give_back()


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes of texts laid end to end belong to words, the words' starts and ends, and the len+1 offsets of the texts' words."""
    ink = ~_SPACE[data]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads] = ink[heads]
    last[tails] = ink[tails]
    starts = np.flatnonzero(first)
    return ink, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_spans(data: np.ndarray, offsets: np.ndarray, cased: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z; `cased`: exact) words of texts laid end to end, their starts and ends, and the len+1 offsets of the texts' words."""
    if not len(data):
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    _, starts, ends, bounds = spans(data, offsets)
    return word_hashes(data if cased else _LOWER[data], starts, ends - starts), starts, ends, bounds


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each row of a string column in order, and the len+1 offsets of the rows' words."""
    hashes, _, _, offsets = word_spans(*text_bytes(column))
    return hashes, offsets


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the stretches [start, start + length), end to end."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row of each element, from the rows' offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def first_by_hash(rows: DataFrame, size: int) -> list[Row]:
    """Per `stratum` the rows with the `size` smallest distinct hashes `h`, in order: one row per hash, however often it comes.

    A bound for the hash is taken from the stratum's count, and widened while it lets too few hashes through, so hashes near the bound are all that is sent; the other
    columns are read for the chosen rows only. No group is ranked in a task. Strata are few, and the driver holds some `size` rows of each.
    """
    counts = {r["stratum"]: r["n"] for r in rows.groupBy("stratum").agg(F.count("*").alias("n")).collect()}
    low, high = -(1 << 63), (1 << 63) - 1
    found: dict[object, list[int]] = {}
    share = {s: 4.0 * size / n for s, n in counts.items()}
    spark = rows.sparkSession
    kind = rows.schema["stratum"].dataType.simpleString()

    def below(limits: dict[object, int]) -> DataFrame:
        bound = spark.createDataFrame(list(limits.items()), f"stratum {kind}, __limit long")
        return rows.join(F.broadcast(bound), "stratum").where("h <= __limit").drop("__limit")

    while share:
        limits = {s: high if x >= 1 else low + int(x * 2.0**64) for s, x in share.items()}
        got: dict[object, list[int]] = {}
        for r in below(limits).select("stratum", "h").distinct().collect():
            got.setdefault(r["stratum"], []).append(r["h"])
        for s, x in list(share.items()):
            if len(got.get(s, [])) >= size or x >= 1:
                found[s] = sorted(got.get(s, []))[:size]
                del share[s]
            else:
                share[s] = 4 * x
    last = {s: hashes[-1] for s, hashes in found.items() if hashes}
    return sorted(below(last).dropDuplicates(["stratum", "h"]).collect(), key=lambda r: (r["stratum"], r["h"])) if last else []


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, component_id) of every id in `links`: the smallest id that it reaches.

    Large-star and small-star by turns (Kiveris et al. 2014): a vertex passes its smallest neighbour to its neighbours,
    so no neighbourhood is listed and rounds are logarithmic. Each round stores the pairs and every vertex's smallest neighbour; all pairs are stars, and the
    result stands, when no vertex that has a smaller neighbour has another one.
    """
    pairs = written(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v").distinct())
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        if not least.where("m < u AND n > 1").limit(1).count():
            return least.select(F.col("u").alias("id"), F.least("u", "m").alias("component_id"))
        large = both.where("v > u").join(least.select("u", F.least("u", "m").alias("m")), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.explode(F.array_distinct(F.array("u", "v"))).alias("u")
        pairs = written(large.join(down, "u").select(ends, F.col("m").alias("v")).where("u <> v").distinct())
