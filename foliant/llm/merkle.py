"""WARC records with a Merkle fixity audit.

A page becomes a WARC/1.1 `resource` record; its leaf is the record's SHA-256. Leaves are in the
order of page_id (then digest) and form ranges of keys, cut at every `fanout`-th leaf of the first
replica and the same for both, so a lost or extra record touches one range (two if its page_id
goes on in the next). A range's hash is the SHA-256 of its leaves, those of the `fanout` ranges or
nodes below in order make the node above, and so on up to a root. An audit builds the tree of each
replica by itself, compares the roots and goes down only where they differ. In ranges that differ,
records equal in page_id and digest are the same; what is left of a page_id on both sides is paired
in the order of digests as `differs`, the rest is missing or extra.

Defined cases: null url or html counts as empty; a null page_id is written as empty and comes
first; equal rows are records of their own, held as one leaf with their number; a very long page is one
record, one row of one task, and only its digest is shuffled; empty tables have
no nodes and no findings; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize, running_totals

FANOUT = 64


def record(page_id, url, html) -> F.Column:
    """The text of a WARC record; the date is a fixed value, as pages carry none."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Date: 2000-01-01T00:00:00Z\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", "%20"),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def leaves(pages: DataFrame, name: str, marks: DataFrame | None = None, fanout: int = FANOUT) -> DataFrame:
    """page_id, digest, size, n, rec_no, start, pos, range: equal records as one leaf, in order, with the number and byte offset of its first
    record. Ranges are of `fanout` leaves, or begin at `marks` (page_id, digest). Only digests are shuffled, no page text."""
    made = pages.select("page_id", record(F.col("page_id"), F.col("url"), F.col("html")).alias("r"))
    made = made.select("page_id", F.octet_length("r").cast("long").alias("size"), F.sha2("r", 256).alias("digest"))
    made = made.groupBy("page_id", "digest").agg(F.max("size").alias("size"), F.count("*").alias("n"))
    rows = made.withColumns({"bytes": F.col("size") * F.col("n"), "one": F.lit(1).cast("long"), "mark": F.lit(0).cast("long")})
    if marks is not None:
        zero = F.lit(0).cast("long")
        rows = rows.unionByName(marks.select("page_id", "digest", *[zero.alias(c) for c in ("size", "n", "bytes", "one")], F.lit(1).cast("long").alias("mark")))
    out = running_totals(rows, ["page_id", "digest", "one"], ["n", "bytes", "one", "mark"], name).filter("one = 1")  # a mark comes before its leaf
    own = F.floor(F.col("before_one") / fanout) if marks is None else F.greatest(F.col("before_mark") - 1, F.lit(0))
    return out.select("page_id", "digest", "size", "n", F.col("before_n").alias("rec_no"), F.col("before_bytes").alias("start"), F.col("before_one").alias("pos"), own.cast("long").alias("range"))


def starts(leaf: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """page_id, digest: where ranges begin; with the first digest of all unless the page_id goes on from the range before."""
    last = leaf.filter(F.col("pos") % fanout == fanout - 1).select((F.col("pos") + 1).alias("pos"), F.col("page_id").alias("_p"), F.lit(True).alias("_has"))
    begun = leaf.filter(F.col("pos") % fanout == 0).join(last, "pos", "left")
    return begun.select("page_id", F.when(F.col("_has") & F.col("_p").eqNullSafe(F.col("page_id")), F.col("digest")).otherwise("").alias("digest"))


def tree(leaf: DataFrame, n: int, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels from the n ranges up to the root: node, digest, from_byte, to_byte. A node has at most `fanout` children.

    A range with more leaves than `fanout` differs from any of the first replica by its number, so only that many and one are hashed.
    """
    spans = leaf.groupBy("range").agg(F.min("pos").alias("first"), F.count("*").alias("leaves"), F.min("start").alias("from_byte"), F.max(F.col("start") + F.col("size") * F.col("n")).alias("to_byte"))
    some = leaf.join(spans, "range").filter(F.col("pos") - F.col("first") <= fanout)
    kids = F.array_sort(F.collect_list(F.struct("pos", F.concat_ws(" ", "digest", F.col("n").cast("string")).alias("d"))))
    ranges = some.groupBy(F.col("range").alias("node")).agg(
        F.sha2(F.concat_ws(",", F.max("leaves").cast("string"), F.array_join(F.transform(kids, lambda x: x["d"]), ",")), 256).alias("digest"), F.max("from_byte").alias("from_byte"), F.max("to_byte").alias("to_byte"))
    levels = [materialize(ranges, "level")]
    while n > 1:
        kids = F.array_sort(F.collect_list(F.struct("node", "digest")))
        up = levels[-1].groupBy(F.floor(F.col("node") / fanout).cast("long").alias("parent")).agg(
            F.sha2(F.array_join(F.transform(kids, lambda x: F.concat_ws(" ", x["node"].cast("string"), x["digest"])), ","), 256).alias("digest"), F.min("from_byte").alias("from_byte"), F.max("to_byte").alias("to_byte"))
        levels.append(materialize(up.withColumnRenamed("parent", "node"), "level"))
        n = -(-n // fanout)
    return levels


def few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(100_000).count() < 100_000 else df


def audit(one: list[DataFrame], two: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """range: those that differ, of two trees over the same ranges. Descends only below nodes that differ."""
    bad = None
    for a, b in reversed(list(zip(one, two, strict=True))):
        if bad is not None:
            below = few(bad)
            a, b = (x.withColumn("_up", F.floor(F.col("node") / fanout).cast("long")).join(below, "_up", "left_semi") for x in (a, b))
        met = a.select("node", F.col("digest").alias("da")).join(b.select("node", F.col("digest").alias("db")), "node", "full")
        bad = materialize(met.filter(~F.col("da").eqNullSafe(F.col("db"))).select(F.col("node").alias("_up")), "differ")
    return bad.withColumnRenamed("_up", "range")


def unmatched(a: DataFrame, b: DataFrame, bad: DataFrame) -> DataFrame:
    """Leaves of ranges that differ with more records on one side: pos (in a, or -1), those of b, lost and more (how many records a and b have
    alone), lost_no and more_no (how many come before in the page_id), pairs (how many of the page_id are on both sides)."""
    below = few(bad)
    one = a.join(below, "range", "left_semi").select(F.col("page_id").alias("_p"), F.col("digest").alias("_d"), F.col("n").alias("na"), "pos")
    two = b.join(below, "range", "left_semi").select("page_id", "digest", "size", "n", "rec_no", "start")
    met = one.join(two, F.col("_p").eqNullSafe(F.col("page_id")) & (F.col("_d") == F.col("digest")), "full")
    or_none = lambda c, x: F.coalesce(F.col(c), F.lit(x).cast("long")).alias(c)
    met = met.select(F.coalesce("page_id", "_p").alias("page_id"), F.coalesce("digest", "_d").alias("digest"), or_none("pos", -1), or_none("na", 0), or_none("n", 0), or_none("size", 0), or_none("rec_no", 0), or_none("start", 0))
    met = met.withColumns({"lost": F.greatest(F.col("na") - F.col("n"), F.lit(0)), "more": F.greatest(F.col("n") - F.col("na"), F.lit(0))}).filter("lost + more > 0")
    run = materialize(running_totals(met, ["page_id", "digest"], ["lost", "more"], "lost"), "unmatched")
    each = run.groupBy(F.col("page_id").alias("_p")).agg(F.min("before_lost").alias("_l"), F.min("before_more").alias("_m"), F.least(F.sum("lost"), F.sum("more")).alias("pairs"))
    out = run.join(each, F.col("page_id").eqNullSafe(F.col("_p")))
    return out.withColumns({"lost_no": F.col("before_lost") - F.col("_l"), "more_no": F.col("before_more") - F.col("_m")}).drop("_p", "_l", "_m", "before_lost", "before_more", "na")


def fixity(pages: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """page_id, rec_no, start, size, digest, state: each record of pages with its place and digest, and what the replica has of it: same, differs
    or missing; and the replica's extra records, with their place and digest there."""
    a = materialize(leaves(pages, "leaves", None, fanout), "leaf")
    b = materialize(leaves(replica, "replica", starts(a, fanout), fanout), "leaf")
    n = -(-a.count() // fanout)
    alone = materialize(unmatched(a, b, audit(tree(a, n, fanout), tree(b, n, fanout), fanout)), "alone")
    i = F.col("i")
    copies = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("i")
    own = a.join(alone.filter("lost > 0").select("pos", "lost", "lost_no", "pairs"), "pos", "left").select("*", copies(F.col("n")))
    past = i - (F.col("n") - F.coalesce("lost", F.lit(0)))  # of a leaf's equal records, the last are those that the replica lacks
    state = F.when(past < 0, "same").when(F.col("lost_no") + past < F.col("pairs"), "differs").otherwise("missing")
    place = lambda k: [(F.col("rec_no") + k).alias("rec_no"), (F.col("start") + k * F.col("size")).alias("start"), "size", "digest"]
    extra = alone.filter("more > 0").select("*", copies(F.col("more"))).filter("more_no + i >= pairs")
    return own.select("page_id", *place(i), state.alias("state")).unionByName(extra.select("page_id", *place(F.col("n") - F.col("more") + i), F.lit("extra").alias("state")))


def write_warc(pages: DataFrame, path: str) -> None:
    """WARC text files, one a partition, whose bytes one after the other (by name) have each record where `leaves` and `fixity` say: in the order of page_id and
    digest. The writer ends each value with \\n, the last character of a record."""
    made = pages.select("page_id", record(F.col("page_id"), F.col("url"), F.col("html")).alias("r")).withColumn("digest", F.sha2("r", 256))
    order = [F.col("page_id").asc_nulls_first(), F.col("digest")]
    made.repartitionByRange(*order).sortWithinPartitions(*order).selectExpr("left(r, length(r) - 1) AS value").write.text(path)
