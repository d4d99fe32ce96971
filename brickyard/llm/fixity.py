"""Fixity audit of WARC replicas by Merkle trees.

Records lie in archives in a fixed order; a leaf is a record's digest with its byte range, a node the digest of up to `FAN` neighbours with their ranges. Two replicas
are compared at their roots, and only branches that differ are followed down, level by level, to the damaged records and their offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickyard.session import written

#: Children of a node, levels above the records, and records that an archive is meant to hold.
FAN, LEVELS, PER_ARCHIVE = 16, 3, 512


def record(url: Column, name: Column, body: Column) -> Column:
    """The bytes of a response record."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nWARC-Record-ID: "), F.coalesce(name.cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def layout(pages: DataFrame) -> DataFrame:
    """archive, seq, first_byte, last_byte, page_id, digest, copies: the manifest of the archives that hold `pages`.

    Archives are runs of `PER_ARCHIVE` page ids, records in them ordered by id, then digest. Repeated rows are one entry with `copies`, which fills as many records' bytes. Rows
    without an id, and runs with more than twice as many entries (ids that repeat), are dealt into several archives by digest. Empty tables give empty ones.
    """
    bytes_ = record(F.col("url"), F.col("page_id"), F.col("html"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(bytes_, 256).alias("digest"), F.octet_length(bytes_).cast("long").alias("length"))
    entries = rows.groupBy("page_id", "digest", "length").agg(F.count("*").alias("copies"))
    run = F.coalesce(F.expr(f"page_id DIV {PER_ARCHIVE}").cast("string"), F.lit("none"))
    entries = written(entries.withColumn("run", run))
    large = entries.groupBy("run").agg(F.count("*").alias("n")).where(F.col("n") > 2 * PER_ARCHIVE)
    large = large.select("run", F.ceil(F.col("n") / PER_ARCHIVE).cast("long").alias("parts"))
    part = F.when(F.col("parts").isNotNull(), F.concat(F.lit("."), F.pmod(F.xxhash64("digest"), F.col("parts")).cast("string"))).otherwise("")
    order = Window.partitionBy("archive").orderBy("page_id", "digest")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("length") * F.col("copies")
    return (
        entries.join(large, "run", "left").withColumn("archive", F.concat("run", part))
        .withColumn("seq", (F.row_number().over(order) - 1).cast("long")).withColumn("first_byte", F.coalesce(F.sum(size).over(ahead), F.lit(0)).cast("long"))
        .select("archive", "seq", "first_byte", (F.col("first_byte") + size).alias("last_byte"), "page_id", "digest", "copies")
    )


def leaves(replica: DataFrame, manifest: DataFrame) -> DataFrame:
    """archive, node, first_byte, last_byte, digest: what a replica holds at the manifest's places.

    `replica`: origin (digest by which the manifest knows the record), page_id, digest (of the bytes as they are read now). Places without bytes give no leaf.
    """
    held = replica.select(F.col("page_id").alias("__id"), "origin", F.col("digest").alias("now")).distinct()
    at = manifest.join(held, F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("origin")))
    return at.groupBy("archive", F.col("seq").alias("node"), "first_byte", "last_byte").agg(F.min("now").alias("digest"))


def tree(leaf: DataFrame) -> list[DataFrame]:
    """Levels from the records to the roots, each stored. A node has at most `FAN` children, so no group grows with the data."""
    levels = [written(leaf)]
    for _ in range(LEVELS):
        child = F.struct("node", F.concat_ws(":", F.col("first_byte").cast("string"), F.col("last_byte").cast("string"), "digest").alias("line"))
        up = levels[-1].groupBy("archive", F.expr(f"node DIV {FAN}").alias("parent")).agg(
            F.min("first_byte").alias("first_byte"), F.max("last_byte").alias("last_byte"), F.sort_array(F.collect_list(child)).alias("children"))
        levels.append(written(up.select("archive", F.col("parent").alias("node"), "first_byte", "last_byte",
                                        F.sha2(F.concat_ws("\n", F.col("children.line")), 256).alias("digest"))))
    return levels


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Places whose digests differ or that only one side has."""
    a = left.select("archive", "node", F.struct("first_byte", "last_byte", "digest").alias("a"))
    b = right.select("archive", "node", F.struct("first_byte", "last_byte", "digest").alias("b"))
    return a.join(b, ["archive", "node"], "full").where(~F.col("a.digest").eqNullSafe(F.col("b.digest")) | ~F.col("a.last_byte").eqNullSafe(F.col("b.last_byte")))


def audit(primary: list[DataFrame], replica: list[DataFrame]) -> DataFrame:
    """archive, node, a, b (range and digest on each side), root_a, root_b: one row per damaged record.

    Levels come from `tree`. Below the roots a level is read for the children of differing nodes only.
    """
    found = differing(primary[-1], replica[-1]).select("archive", "node", F.col("a.digest").alias("root_a"), F.col("b.digest").alias("root_b"))
    found = written(found)
    for left, right in zip(reversed(primary[:-1]), reversed(replica[:-1]), strict=True):
        parent = F.expr(f"node DIV {FAN}").alias("parent")
        above = found.select("archive", F.col("node").alias("parent"), "root_a", "root_b")
        sides = [side.withColumn("parent", parent).join(above, ["archive", "parent"], "left_semi").drop("parent") for side in (left, right)]
        found = written(differing(*sides).withColumn("parent", parent).join(above, ["archive", "parent"]).drop("parent"))
    return found


def damaged_copy(pages: DataFrame) -> DataFrame:
    """A replica of `pages` with planted damage: ids that are 7 modulo 101 have another first character, ids that are 8 modulo 101 are lost."""
    turn = F.coalesce(F.col("page_id") % 101, F.lit(0))
    other = F.when(F.substring("html", 1, 1) == "#", "!").otherwise("#")
    body = F.when((turn == 7) & (F.length("html") > 0), F.concat(other, F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    rows = pages.where(turn != 8).select("page_id", "url", "html", body.alias("body"))
    return rows.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(record(F.col("url"), F.col("page_id"), F.col("html")), 256).alias("origin"),
                       F.sha2(record(F.col("url"), F.col("page_id"), F.col("body")), 256).alias("digest"))


def audit_pages(pages: DataFrame) -> DataFrame:
    """archive, record_no, page_id, first_byte, last_byte, damage, primary_digest, replica_digest, primary_root, replica_root.

    One row per record of the archives of `pages` that the damaged copy holds otherwise or not at all. Null url or html count as empty; rows without an id are never damaged;
    repeated rows are one entry. An empty table gives an empty result; other columns are ignored.
    """
    manifest = written(layout(pages))
    primary = tree(manifest.select("archive", F.col("seq").alias("node"), "first_byte", "last_byte", "digest"))
    replica = tree(leaves(damaged_copy(pages), manifest))
    found = audit(primary, replica)
    named = found.join(manifest.select("archive", F.col("seq").alias("node"), "page_id"), ["archive", "node"])
    return named.select("archive", F.col("node").alias("record_no"), "page_id", F.col("a.first_byte").alias("first_byte"), F.col("a.last_byte").alias("last_byte"),
                        F.when(F.col("b").isNull(), "missing").otherwise("changed").alias("damage"), F.col("a.digest").alias("primary_digest"),
                        F.col("b.digest").alias("replica_digest"), F.col("root_a").alias("primary_root"), F.col("root_b").alias("replica_root"))


def _sql() -> str:
    def rec(body: str) -> str:
        return (f"'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Record-ID: '"
                f" || page_id || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce({body}, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce({body}, '')"
                " || chr(13) || chr(10) || chr(13) || chr(10)")

    parts = [f"""p AS (SELECT page_id, {rec('html')} AS r, {rec('body')} AS s FROM (SELECT *, CASE WHEN page_id % 101 = 7 AND length(html) > 0
        THEN CASE WHEN substr(html, 1, 1) = '#' THEN '!' ELSE '#' END || substr(html, 2) ELSE html END AS body FROM pages)),
    m AS (SELECT CAST(page_id // {PER_ARCHIVE} AS VARCHAR) AS archive, row_number() OVER w - 1 AS node, page_id, sum(strlen(r)) OVER w AS last_byte,
        sum(strlen(r)) OVER w - strlen(r) AS first_byte, sha256(r) AS a, sha256(s) AS b FROM p WINDOW w AS (PARTITION BY page_id // {PER_ARCHIVE} ORDER BY page_id)),
    a0 AS (SELECT archive, node, first_byte, last_byte, a AS digest FROM m),
    b0 AS (SELECT archive, node, first_byte, last_byte, b AS digest FROM m WHERE page_id % 101 <> 8)"""]
    for side in "ab":
        for i in range(LEVELS):
            parts.append(f"""{side}{i + 1} AS (SELECT archive, node // {FAN} AS node, min(first_byte) AS first_byte, max(last_byte) AS last_byte,
        sha256(string_agg(first_byte || ':' || last_byte || ':' || digest, chr(10) ORDER BY node)) AS digest FROM {side}{i} GROUP BY archive, node // {FAN})""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT m.archive, m.node AS record_no, m.page_id, CAST(m.first_byte AS BIGINT) AS first_byte, CAST(m.last_byte AS BIGINT) AS last_byte,
    CASE WHEN page_id % 101 = 8 THEN 'missing' ELSE 'changed' END AS damage, m.a AS primary_digest, CASE WHEN page_id % 101 <> 8 THEN m.b END AS replica_digest,
    x.digest AS primary_root, y.digest AS replica_root
FROM m LEFT JOIN a{LEVELS} AS x ON x.archive = m.archive AND x.node = m.node // {FAN ** LEVELS} LEFT JOIN b{LEVELS} AS y ON y.archive = m.archive AND y.node = m.node // {FAN ** LEVELS}
WHERE page_id % 101 = 8 OR m.a <> m.b"""


ORACLE = _sql()
