"""Document fingerprints from closed syncmers (DataFrame functions only).

A k-mer is K words in a row; it is an anchor if the least hash among its runs of S words lies at its first or last one. Whether a k-mer is an anchor depends on
its own words only, never on its neighbours, so a passage keeps its anchors wherever it stands and whatever is edited around it, and no gap between anchors is
longer than K - S words. A fingerprint is all the text's anchors and where they first stand, or on demand those with the smallest hashes only; two fingerprints are
matched by equal anchors that agree on how far one text is shifted against the other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickyard.llm.common import SPACES
from brickyard.session import written

#: Words of a k-mer and of the runs inside it.
K, S = 5, 2
#: Anchors that a short fingerprint keeps; None stands for all of them.
SKETCH = 64
#: Words by which the shifts of matching anchors may differ: what insertions and deletions between them move.
SLACK = 64
#: Hash bits of an anchor; its place, less than 2^31, takes the lower 32 of a long.
HASH_BITS = 31
SECOND = 1 << 31
KEY = ["none", "id", "digest"]


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, s: int = S, sketch: int | None = SKETCH) -> DataFrame:
    """`name`: the text's anchors, or those with the `sketch` smallest hashes, rising, as longs of hash and first place (a word number).

    A text with words, but fewer than `k`, has one anchor, all its words; one without words has none. Each step is a column of its own, which later steps use
    more than once, so that Spark computes it once a row.
    """
    bare = F.btrim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))
    df = df.withColumn("__w", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACES}]+")))
    runs = [F.slice("__w", j + 1, F.size("__w")) for j in range(s)]
    inner = F.xxhash64("__w") if s == 1 else reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y)), runs)
    df = df.withColumn("__n", F.size("__w")).withColumn("__g", inner if s > 1 else F.transform("__w", lambda w: F.xxhash64(w)))
    at = [lambda i, j=j: F.get("__g", i + j) for j in range(k - s + 1)]
    closed = F.filter(F.sequence(F.lit(0), F.col("__n") - k), lambda i: F.least(*[a(i) for a in at]) == F.least(at[0](i), at[-1](i)))
    packed = F.transform(closed, lambda i: place(F.xxhash64(*[a(i) for a in at]), i))
    short = F.when(F.col("__n") == 0, F.array().cast("array<bigint>")).otherwise(F.array(place(F.xxhash64("__w"), F.lit(0))))
    df = df.withColumn("__a", F.sort_array(F.when(F.col("__n") >= k, packed).otherwise(short)))
    first = F.filter("__a", lambda x, i: (i == 0) | (hash_of(x) != hash_of(F.get("__a", i - 1))))
    return df.withColumn(name, F.slice(first, 1, sketch) if sketch else first).drop("__w", "__n", "__g", "__a")


def place(hashed: Column, at: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(hashed, 64 - HASH_BITS), 32).bitwiseOR(at.cast("long"))


def hash_of(anchor: Column) -> Column:
    return F.shiftright(anchor, 32)


def place_of(anchor: Column) -> Column:
    return anchor.bitwiseAND((1 << 32) - 1)


def as_text(sketch: str) -> Column:
    """`hash:place` of each anchor, hash in eight hexadecimal digits, joined by commas."""
    return F.array_join(F.transform(sketch, lambda x: F.concat(F.lpad(F.lower(F.hex(hash_of(x))), 8, "0"), F.lit(":"), place_of(x))), ",")


def with_likeness(df: DataFrame, a: str, b: str, name: str, sketch: int | None = SKETCH, slack: int = SLACK) -> DataFrame:
    """`name`: the share of both texts' anchors that match, 0 to 1; 1 for equal fingerprints, two empty ones included.

    Of the hashes in either fingerprint (of the `sketch` smallest, unless both fingerprints hold all their texts' anchors) those count that are in both and whose
    shift of place lies within `slack` of the shift that most of them have. With j the share of these, 2j / (1 + j) is the part of the two anchor sets that they
    make up. Anchors meet by sorting, so the cost of two fingerprints hardly grows faster than their length.
    """
    df = df.withColumn("__z", F.sort_array(F.concat(a, F.transform(b, lambda x: x.bitwiseOR(SECOND)))))
    if sketch:
        some = F.slice(F.sort_array(F.array_union(F.transform(a, hash_of), F.transform(b, hash_of))), 1, sketch)
        df = df.withColumn("__last", F.when((F.size(a) >= sketch) | (F.size(b) >= sketch), F.array_max(some)).otherwise(1 << HASH_BITS))
        df = df.withColumn("__z", F.filter("__z", lambda x: hash_of(x) <= F.col("__last"))).drop("__last")
    met = F.zip_with("__z", F.slice("__z", 2, F.size("__z")), lambda x, y: F.when(hash_of(x) == hash_of(y), place_of(x) - place_of(y.bitwiseXOR(SECOND))))
    df = df.withColumn("__t", F.sort_array(F.array_compact(met)))
    n = F.size("__t")
    df = df.withColumn("__m", F.when(n == 0, 0).when(F.get("__t", n - 1) - F.get("__t", F.lit(0)) <= slack, n).otherwise(agreeing("__t", slack)))
    like = 2.0 * F.col("__m") / (F.size("__z") - n + F.col("__m"))
    return df.withColumn(name, F.when(F.col(a) == F.col(b), 1.0).otherwise(like)).drop("__z", "__t", "__m")


def agreeing(shifts: str, slack: int) -> Column:
    """Most shifts that lie within `slack` of one of them; `shifts` rise.

    Each shift asks, in one sort with all shifts, how many are at most `slack` greater (odd numbers, which come after equal shifts), and in another how many are
    more than `slack` smaller (even ones, which come before). The k-th question stands k places too far in both, which the difference drops.
    """
    upper = F.sort_array(F.concat(F.transform(shifts, lambda t: 2 * t), F.transform(shifts, lambda t: 2 * (t + slack) + 1)))
    lower = F.sort_array(F.concat(F.transform(shifts, lambda t: 2 * t + 1), F.transform(shifts, lambda t: 2 * (t - slack))))
    last = F.array_compact(F.transform(upper, lambda t, i: F.when(t.bitwiseAND(1) == 1, i)))
    first = F.array_compact(F.transform(lower, lambda t, i: F.when(t.bitwiseAND(1) == 0, i)))
    return F.array_max(F.zip_with(last, first, lambda u, v: u - v))


def successors(keys: DataFrame) -> DataFrame:
    """Each key's successor in the order of KEY as next_none, next_id, next_digest; the last one's is the first.

    Keys lie in ranges: within one the successor is the next row, and its last key goes on with the first of the next range, of which there are as
    many as partitions.
    """
    ranges = written(keys.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()))
    inner = Window.partitionBy("part").orderBy(*KEY)
    heads = ranges.groupBy("part").agg(F.min(F.struct(*KEY)).alias("head"))
    order = Window.orderBy("part")
    after = heads.select("part", F.coalesce(F.lead("head").over(order), F.first("head").over(order)).alias("after"))
    follow = ranges.withColumn("next", F.lead(F.struct(*KEY)).over(inner)).join(F.broadcast(after), "part")
    follow = follow.withColumn("next", F.coalesce("next", "after"))
    return follow.select(*keys.columns, *[F.col(f"next.{c}").alias(f"next_{c}") for c in KEY])


def fingerprints(docs: DataFrame, sketch: int | None = SKETCH) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row per row of `docs`.

    `sketch` None: fingerprints hold all anchors, so that both likenesses are exact; else the `sketch` with the smallest hashes, for which they are estimated.
    The next document is the one with the next greater doc_id; rows without an id come after the others, rows that share an id follow each other by their text's
    digest, and rows equal in both are interchangeable: each but the last is followed by its own copy. The last document is followed by the first, a single one by
    itself. A null text is empty. A text without words has an empty fingerprint. An empty table gives an empty result; other columns are ignored. Texts are sent
    twice, as a row's own and as the next one's, with equal rows joined before: all their anchors would take more. The keys, without texts, are stored in the
    checkpoint folder.
    """
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    long = F.col("doc_id").cast("long")
    base = docs.select(long.isNull().alias("none"), F.coalesce(long, F.lit(0)).alias("id"), F.unhex(F.sha2(whole, 256)).alias("digest"), whole.alias("text"))
    counted = base.groupBy(*KEY, F.floor(F.char_length("text") / 4).cast("int").alias("cut")).agg(F.count("*").alias("copies"))
    links = successors(counted)
    rows = base.dropDuplicates(KEY)
    follower = [F.col(f"next_{c}") == F.col(f"r.{c}") for c in KEY]
    after = links.alias("l").join(rows.alias("r"), reduce(Column.__and__, follower)).select(
        *[F.col(f"l.{c}") for c in KEY], "cut", "copies", F.col("r.text").alias("after"))
    both = rows.join(after, KEY)
    both = with_sketch(with_sketch(both, "text", "sketch", sketch=sketch), "after", "next_sketch", sketch=sketch)
    both = both.withColumn("left", F.explode(F.expr("sequence(copies - 1, 0, -1)"))).withColumn("n_chars", F.char_length("text"))
    own = F.col("left") > 0
    both = both.withColumn("after", F.when(own, F.col("text")).otherwise(F.col("after")))
    both = both.withColumn("next_sketch", F.when(own, F.col("sketch")).otherwise(F.col("next_sketch")))
    both = both.withColumn("edited", F.expr("concat(substring(text, 1, n_chars - cut), substring(after, 1, cut))")).drop("text", "after")
    both = both.withColumn("edited_sha256", F.sha2("edited", 256))
    both = with_sketch(both, "edited", "edited_sketch", sketch=sketch).drop("edited")
    both = with_likeness(with_likeness(both, "sketch", "edited_sketch", "near_edited", sketch), "sketch", "next_sketch", "near_next", sketch)
    return both.select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", as_text("sketch").alias("fingerprint"),
        as_text("edited_sketch").alias("edited_fingerprint"), "near_edited", "near_next",
    )
