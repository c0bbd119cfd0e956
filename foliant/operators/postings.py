"""Postings of words, and a stored index of them in segments of blocks that grows without being built anew (SNK-2, FTS-1)."""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"([\p{L}\p{N}]+)"
RANGE = 4096  # documents of a range, about
FEW = 100_000  # documents of a part of a query that is rare enough to be broadcast
LISTED = 1000  # ranges that a filter names one by one
Word = tuple[str, bool]  # a word, or the beginning of words
Leaf = tuple[tuple[str, ...], bool]  # words that follow each other, the last one whole or a beginning


def terms_of(text: str) -> list[str]:
    """The words of a query, by the rule of WORD: letters and digits."""
    return re.findall(r"[^\W_]+", text.lower())


def words(text) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(1))


def postings(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """term, doc, pos (from 0)."""
    return docs.select(F.col(doc_id).alias("doc"), F.posexplode(words(F.col(text))).alias("pos", "term")).select("term", "doc", "pos")


class SearchIndex:
    """A folder of segments. A segment has the documents of one `append` in ranges of about RANGE, and for each word and range one block: n, and
    the documents in order, each with its places in order. Blocks are sorted by word and range and written with Parquet's delta encoding, so a search reads the row groups of
    its words only. Beside them stands how many documents each word has.

    The segments in force are named by the newest complete entry of `live`, which is written last: an append or merge that fails
    leaves the index as it was, and readers that began before go on with their segments. `merge` makes one segment of all.
    A document belongs in one append only; appended twice, it is found as one document with the places of both. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def live(self) -> tuple[int, list[str]]:
        """The number of the newest entry and its segments."""
        fs, at = self._folder(f"{self.path}/live")
        jvm = self.spark.sparkContext._jvm
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        whole = [n for n in names if n.isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(at, f"{n}/_SUCCESS"))]
        if not whole:
            return 0, []
        newest = max(whole, key=int)
        return int(newest), json.loads(self.spark.read.text(f"{self.path}/live/{newest}").first()[0])

    def _enter(self, number: int, segments: list[str]) -> None:
        self.spark.createDataFrame([(json.dumps(segments),)], "value string").coalesce(1).write.text(f"{self.path}/live/{number:08d}")

    def append(self, docs: DataFrame, doc_id: str, text: str) -> SearchIndex:
        """Adds the documents as a segment of their own; nothing that is there is read or written."""
        number, segments = self.live()
        n = docs.count()
        own = dealt(docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("_text")), n)  # whole texts are shuffled, not their words
        rows = own.select("range", "doc", F.posexplode(words(F.col("_text"))).alias("pos", "term"))
        self._enter(number + 1, [*segments, self._write(blocks_of(rows, F.collect_list("pos")))])
        return self

    def _write(self, blocks: DataFrame) -> str:
        """Blocks are put in order from a table of their own, as dividing them into ranges of words goes through its input twice."""
        name = f"segments/{uuid.uuid4().hex}"
        compact = lambda df: df.write.option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "false")
        compact(blocks).parquet(f"{self.path}/{name}/unsorted")
        made = self.spark.read.schema(blocks.schema).parquet(f"{self.path}/{name}/unsorted")
        compact(made.repartitionByRange("term", "range").sortWithinPartitions("term", "range")).parquet(f"{self.path}/{name}/blocks")
        fs, at = self._folder(f"{self.path}/{name}/unsorted")
        fs.delete(at, True)
        counts = self._blocks(name).groupBy("term").agg(F.sum("n").alias("df"))
        counts.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{self.path}/{name}/terms")
        return name

    def _blocks(self, segment: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{segment}/blocks")

    def merge(self) -> SearchIndex:
        """One segment of all. The old ones are deleted by `sweep`, once no reader uses them."""
        number, segments = self.live()
        if len(segments) > 1:
            blocks = reduce(DataFrame.unionByName, [self._blocks(s) for s in segments])
            rows = opened(blocks, places=True)
            n = rows.select("doc").distinct().count()
            name = self._write(blocks_of(dealt(rows, n), F.flatten(F.collect_list("places"))))
            self._enter(number + 1, [name])
        return self

    def sweep(self) -> SearchIndex:
        """Deletes segments that are not in force, and those of appends that failed."""
        segments = {s.rpartition("/")[2] for s in self.live()[1]}
        fs, at = self._folder(f"{self.path}/segments")
        for f in fs.listStatus(at) if fs.exists(at) else []:
            if f.getPath().getName() not in segments:
                fs.delete(f.getPath(), True)
        return self

    def frequencies(self, asked: list[Word]) -> dict[Word, int]:
        """How many documents have each word; of a prefix, at most how many: the sum of its words'."""
        segments = self.live()[1]
        if not segments or not asked:
            return dict.fromkeys(asked, 0)
        terms = reduce(DataFrame.unionByName, [self.spark.read.parquet(f"{self.path}/{s}/terms") for s in segments]).filter(_any(asked))
        sums = terms.agg(*[F.coalesce(F.sum(F.when(_is(*a), F.col("df"))), F.lit(0)) for a in asked]).first()
        return dict(zip(asked, sums))

    def postings(self, leaves: list[Leaf] | None = None, needed: list[list[Leaf]] = ()) -> DataFrame:
        """term, doc, pos of the leaves' words (of all words if None). needed: lists of leaves, of each of which a document must have one: if the rarest of them
        has FEW documents at most, only blocks of ranges with these are opened, and only their postings given."""
        segments = self.live()[1]
        if not segments:
            return self.spark.createDataFrame([], "term string, doc long, pos int")
        blocks = reduce(DataFrame.unionByName, [self._blocks(s).withColumn("segment", F.lit(i)) for i, s in enumerate(segments)])
        if leaves is None:
            return opened(blocks)
        asked = sorted({w for leaf in leaves for w in words_of(leaf)})
        if not asked:
            return opened(blocks.limit(0))
        own, of = blocks.filter(_any(asked)), self.frequencies(asked)
        heads = [[min(words_of(leaf), key=of.get) for leaf in part if leaf[0]] for part in needed]  # of a phrase, its rarest word
        rare = min(heads, key=lambda part: sum(of[w] for w in part), default=asked)
        if set(rare) == set(asked) or sum(of[w] for w in rare) > FEW:
            return opened(own)
        first = blocks.filter(_any(rare)) if rare else blocks.limit(0)
        ranges = [r["range"] for r in first.select("range").distinct().limit(LISTED + 1).collect()]
        if len(ranges) <= LISTED:  # the filter reaches the scan
            own = own.filter(F.col("range").isin(*ranges) if ranges else F.lit(False))
        return opened(own).join(F.broadcast(opened(first).select("doc").distinct()), "doc", "left_semi")  # FEW documents at most, by the counts


def words_of(leaf: Leaf) -> list[Word]:
    words_, prefix = leaf
    return [(w, prefix and k == len(words_) - 1) for k, w in enumerate(words_)]


def _is(word: str, prefix: bool) -> Column:
    return F.col("term").startswith(word) if prefix else F.col("term") == word


def _any(asked: list[Word]) -> Column:
    exact = [w for w, prefix in asked if not prefix]
    tests = ([F.col("term").isin(*exact)] if exact else []) + [F.col("term").startswith(w) for w, prefix in asked if prefix]
    return reduce(lambda a, b: a | b, tests)


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """rows with the range of their doc, dealt out by it; n: how many documents there are. Twice as many tasks as ranges, so that few tasks have several."""
    ranges = max(1, -(-n // RANGE))
    return rows.withColumn("range", F.pmod(F.xxhash64("doc"), F.lit(ranges)).cast("int")).repartition(2 * ranges, "range")


def blocks_of(rows: DataFrame, places: Column) -> DataFrame:
    """rows: range, doc, term and what `places` takes, dealt out by range: blocks are made where these are, without another shuffle."""
    each = rows.groupBy("range", "term", "doc").agg(F.array_sort(places).alias("places"))
    blocks = each.groupBy("range", "term").agg(F.array_sort(F.collect_list(F.struct("doc", "places"))).alias("b"))
    return blocks.select("term", "range", F.size("b").alias("n"), F.col("b.doc").alias("docs"), F.col("b.places").alias("places"))


def opened(blocks: DataFrame, places: bool = False) -> DataFrame:
    """term, doc, pos of blocks; or term, doc, places, one row a word and document."""
    each = blocks.select("term", F.explode(F.arrays_zip("docs", "places")).alias("b"))
    if places:
        return each.select("term", F.col("b.docs").alias("doc"), F.col("b.places").alias("places"))
    return each.select("term", F.col("b.docs").alias("doc"), F.explode("b.places").alias("pos"))
