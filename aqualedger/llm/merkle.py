"""Merkle fixity audit of WARC records: two replicas are compared by their trees' roots, and
only branches that differ are descended, down to the records that differ.

Records of a file lie at ordered offsets.  A leaf hashes the records whose offsets fall into
one fixed byte range; a node of a higher level hashes ``fanout`` ranges of the level below in
order.  Trees are grouped hashes, one pass per level over a table that shrinks by the fanout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .util import each_copy, materialize, order_id

COPIES_AT_ONCE = 65536


def warc_payload(url: str = "url", html: str = "html") -> Column:
    """A response record's block as UTF-8 bytes: null fields count as empty."""
    uri, body = F.coalesce(F.col(url), F.lit("")), F.coalesce(F.col(html), F.lit(""))
    return F.concat(
        F.encode(F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), uri, F.lit("\r\nContent-Length: ")), "UTF-8"),
        F.encode(F.octet_length(body).cast("string"), "UTF-8"), F.encode(F.lit("\r\n\r\n"), "UTF-8"), F.encode(body, "UTF-8"), F.encode(F.lit("\r\n\r\n"), "UTF-8"),
    )


def warc_records(pages: DataFrame, pages_per_file: int = 1024, id_col: str = "page_id") -> DataFrame:
    """(page_id, file, offset, length, digest): pages as WARC records, ``pages_per_file`` ids to a
    file, in order of page_id.  Pages with a null id form the last file.  Rows that repeat an id
    follow each other by digest; equal rows are counted first and laid end to end.

    Offsets are sums of two parts: where the records of an id and leading digest digits begin,
    from one row for each of these in a file, and the place among them.  So an id, or the null
    ids, may hold any share of the rows without one task seeing them all."""
    payload = warc_payload()
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), order_id(id_col).alias("id"),
        F.octet_length(payload).cast("long").alias("length"), F.sha2(payload, 256).alias("digest"),
    ).groupBy("page_id", "id", "length", "digest").agg(F.count("*").alias("n"))
    rows = rows.withColumn("lead", F.substring("digest", 1, 3)).withColumn("size", F.col("length") * F.col("n"))

    def before(keys: list[str], order: list[str]) -> Column:
        window = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
        return F.sum("size").over(window) - F.col("size")

    file = F.floor(F.col("id") / pages_per_file).cast("long")
    heads = rows.groupBy("id", "lead").agg(F.sum("size").alias("size")).withColumn("file", file)
    heads = heads.select("id", "lead", "file", before(["file"], ["id", "lead"]).alias("head"))
    placed = rows.join(heads, ["id", "lead"]).withColumn("start", F.col("head") + before(["id", "lead"], ["digest", "page_id"]))
    return each_copy(placed, "n", "copy", COPIES_AT_ONCE).select("page_id", "file", (F.col("start") + F.col("copy") * F.col("length")).alias("offset"), "length", "digest")


def _hashed(items: Column) -> Column:
    """Hash of an array of (position, digest) in order of position."""
    return F.sha2(F.concat_ws("|", F.transform(F.array_sort(items), lambda x: F.concat_ws(":", x["at"].cast("string"), x["digest"]))), 256)


def leaves(records: DataFrame, leaf_bytes: int) -> DataFrame:
    """(file, level 0, node, digest): node is the number of the offset range.  A range holds
    records that start within ``leaf_bytes`` bytes, however many there are in the file."""
    item = F.struct(F.col("offset").alias("at"), F.concat_ws("/", F.col("length").cast("string"), F.col("digest")).alias("digest"))
    node = F.floor(F.col("offset") / leaf_bytes).cast("long")
    return records.groupBy("file", node.alias("node")).agg(_hashed(F.collect_list(item)).alias("digest"))


def tree(records: DataFrame, leaf_bytes: int = 65536, fanout: int = 16) -> list[DataFrame]:
    """Levels from the leaves to the roots (one node per file), each written out.  Levels end
    where every file has come down to its node 0; their number is the logarithm of the longest
    file."""
    levels = [materialize(leaves(records, leaf_bytes), "merkle-0")]
    while (levels[-1].agg(F.max("node")).first()[0] or 0) > 0:
        below = levels[-1].select("file", F.floor(F.col("node") / fanout).cast("long").alias("up"), F.struct(F.col("node").alias("at"), "digest").alias("item"))
        level = below.groupBy("file", F.col("up").alias("node")).agg(_hashed(F.collect_list("item")).alias("digest"))
        levels.append(materialize(level, f"merkle-{len(levels)}"))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(file, node, kind) where the digests differ or one side has no such node."""
    x, y = a.toDF("file", "node", "digest_a"), b.toDF("file", "node", "digest_b")
    both = x.join(y, ["file", "node"], "full").where(~F.col("digest_a").eqNullSafe(F.col("digest_b")))
    return both.select("file", "node")


def audit(a: DataFrame, b: DataFrame, leaf_bytes: int = 65536, fanout: int = 16) -> DataFrame:
    """Records (file, offset, length, digest, ...) of two replicas -> (file, leaf, offset, kind,
    length_a, length_b, digest_a, digest_b) for each offset at which they differ; kind is
    'changed', 'missing' (not in b) or 'extra' (not in a).

    Roots are compared first; each lower level is read only under nodes that differ.  Records that
    repeat within a replica compare as a whole: by number and content at an offset.  Empty
    replicas have no nodes; two of them do not differ."""
    one, other = tree(a, leaf_bytes, fanout), tree(b, leaf_bytes, fanout)
    top = max(len(one), len(other)) - 1

    def at(levels: list[DataFrame], level: int, under: DataFrame | None) -> DataFrame:
        found = levels[min(level, len(levels) - 1)].select("file", "node", "digest")
        if level >= len(levels):  # a lower tree: its root stands in for the levels above, never equal to them
            found = found.withColumn("digest", F.concat(F.lit("low:"), "digest"))
        if under is None:
            return found
        up = under.select(F.col("file").alias("f"), F.col("node").alias("up"))
        return found.join(up, (F.col("file") == F.col("f")) & (F.floor(F.col("node") / fanout) == F.col("up")), "left_semi")

    open_ = None
    for level in range(top, -1, -1):
        open_ = materialize(_differing(at(one, level, open_), at(other, level, open_)), "merkle-open")

    def records(r: DataFrame, side: str) -> DataFrame:
        node = F.floor(F.col("offset") / leaf_bytes).cast("long")
        own = r.select("file", node.alias("leaf"), "offset", "length", "digest").join(
            open_.select(F.col("file").alias("f"), F.col("node").alias("n")), (F.col("file") == F.col("f")) & (F.col("leaf") == F.col("n")), "left_semi"
        )
        return own.groupBy("file", "leaf", "offset").agg(F.max("length").alias(f"length_{side}"), F.array_join(F.array_sort(F.collect_list("digest")), ",").alias(f"digest_{side}"))

    both = records(a, "a").join(records(b, "b"), ["file", "leaf", "offset"], "full").where("not (digest_a <=> digest_b and length_a <=> length_b)")
    kind = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return both.select("file", "leaf", "offset", kind.alias("kind"), "length_a", "length_b", "digest_a", "digest_b")
