"""Full-text search on a postings table or on a stored index of segments (FTS-1 … FTS-8, JN-4, JN-5, AGG-11, SNK-2)."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .postings import SearchIndex, postings, terms_of, words  # noqa: F401

def write_postings(index: DataFrame, path: str) -> DataFrame:
    """The index as a Parquet table in ranges of terms, sorted: a search reads only the row groups that may hold its terms."""
    index.repartitionByRange("term", "doc").sortWithinPartitions("term", "doc", "pos").write.mode("overwrite").parquet(path)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def base_rows(found: DataFrame, docs: DataFrame, doc_id: str) -> DataFrame:
    """JN-4: the rows of docs that a search has found."""
    return docs.join(found.select(F.col("doc").alias(doc_id)).distinct(), doc_id, "left_semi")


def match_groups(index: DataFrame, groups: list[list[str]]) -> DataFrame:
    """FTS-1, FTS-2: docs with a term of every group: one pass with a filter pushed to the terms, one grouping by document."""
    if not groups or not all(groups):
        return index.select("doc").limit(0)
    hit = [F.max(F.col("term").isin(*[t.lower() for t in g])).alias(f"g{k}") for k, g in enumerate(groups)]
    found = index.filter(F.col("term").isin(*{t.lower() for g in groups for t in g})).groupBy("doc").agg(*hit)
    return found.filter(reduce(lambda a, b: a & b, [F.col(f"g{k}") for k in range(len(groups))])).select("doc")


def match_phrase(index: DataFrame, phrase: str) -> DataFrame:
    """FTS-3: doc, pos of each place where the words follow each other; word k votes for the place pos - k."""
    terms = terms_of(phrase)
    places = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(k).alias("k")) for k, t in enumerate(terms)])
    votes = index.filter(F.col("term").isin(*terms)).select("doc", F.explode(F.filter(F.transform(places, lambda x: F.when(x["t"] == F.col("term"), F.col("pos") - x["k"])), lambda p: p.isNotNull())).alias("pos"))
    return votes.groupBy("doc", "pos").count().filter(F.col("count") == len(terms)).select("doc", "pos")


TOKEN = re.compile(r'\s*(?:(?P<mark>[()+])|"(?P<quoted>(?:[^"]|"")*)"(?P<any>\s*\*)?|(?P<word>[^\s()"+]+))')


@dataclass
class Query:
    """A query as a tree of ("or" | "and" | "not", left, right) over numbers of its leaves: words that follow each other, the last one a prefix or not."""

    tree: tuple | int = -1
    leaves: list[tuple[tuple[str, ...], bool]] = field(default_factory=list)


def read_query(text: str) -> Query | None:
    """FTS-2, FTS-6, FN-11: words, "phrases", one + two, prefixes*, brackets, NOT before AND before OR, side by side (closest of all) as AND. None if it cannot be read.

    Operators are in capitals, as in quotes they are words; what a word has beside letters and digits parts it into a phrase.
    """
    tokens, at, out = [], 0, Query()
    while text[at:].strip():
        m = TOKEN.match(text, at)
        if not m:
            return None
        at = m.end()
        quoted, word = m["quoted"], m["word"]
        if m["mark"] or word in ("AND", "OR", "NOT"):
            tokens.append(m["mark"] or word)
        else:
            tokens.append((tuple(terms_of(word if quoted is None else quoted)), bool(m["any"]) or bool(word and word.endswith("*"))))
    tokens.append(None)
    place = 0

    def peek():
        return tokens[place]

    def take():
        nonlocal place
        place += 1
        return tokens[place - 1]

    def either(operator: str, operand):
        left = operand()
        while peek() == operator:
            take()
            left = (operator.lower(), left, operand())
        return left

    def beside():
        left = single()
        while isinstance(peek(), tuple) or peek() == "(":
            left = ("and", left, single())
        return left

    def single():
        token = take()
        if token == "(":
            inside = ors()
            if take() != ")":
                raise ValueError
            return inside
        if not isinstance(token, tuple):
            raise ValueError
        words_, prefix = token
        while peek() == "+":
            take()
            more = take()
            if not isinstance(more, tuple):
                raise ValueError
            words_, prefix = words_ + more[0], more[1]
        leaf = (words_, prefix and bool(words_))
        if leaf not in out.leaves:
            out.leaves.append(leaf)
        return out.leaves.index(leaf)

    nots = lambda: either("NOT", beside)
    ands = lambda: either("AND", nots)
    ors = lambda: either("OR", ands)
    try:
        out.tree = ors()
    except (ValueError, IndexError):
        return None
    return out if peek() is None else None


def is_word(term, word: str, prefix: bool) -> Column:
    return term.startswith(word) if prefix else term == word


def hits(index: DataFrame, leaves: list[tuple[tuple[str, ...], bool]]) -> DataFrame:
    """doc, h (flags of the leaves): one pass over the asked postings. Word k of a phrase votes for the place pos - k; a place with a vote of each word is a hit."""
    term, ends = F.col("term"), [(i, k, w, prefix and k == len(ws) - 1) for i, (ws, prefix) in enumerate(leaves) for k, w in enumerate(ws)]
    if not ends:
        return index.select("doc", F.array(*[F.lit(False)] * len(leaves)).alias("h")).limit(0)
    asked = index.filter(reduce(lambda a, b: a | b, [is_word(term, w, p) for _, _, w, p in ends]))
    flags = lambda hit: F.array(*[F.coalesce(F.max(hit(i)), F.lit(False)) for i in range(len(leaves))]).alias("h")
    if all(len(ws) == 1 for ws, _ in leaves):
        return asked.groupBy("doc").agg(flags(lambda i: is_word(term, leaves[i][0][0], leaves[i][1])))
    place = lambda i, k: F.lit(0) if len(leaves[i][0]) == 1 else (F.col("pos") - k).cast("int")
    votes = F.array(*[F.when(is_word(term, w, p), F.struct(F.lit(i).alias("leaf"), place(i, k).alias("place"))) for i, k, w, p in ends])
    each = asked.select("doc", F.explode(F.filter(votes, lambda v: v.isNotNull())).alias("v")).select("doc", "v.leaf", "v.place").repartition("doc")
    need = F.element_at(F.array(*[F.lit(len(ws)) for ws, _ in leaves]), F.col("leaf") + 1)
    whole = each.groupBy("doc", "leaf", "place").agg(F.count("*").alias("n")).filter((F.col("n") == need) | (need == 1))
    return whole.groupBy("doc").agg(flags(lambda i: F.col("leaf") == i))


def holds(tree: tuple | int) -> Column:
    if isinstance(tree, int):
        return F.get("h", F.lit(tree))
    kind, left, right = tree
    return holds(left) | holds(right) if kind == "or" else holds(left) & (~holds(right) if kind == "not" else holds(right))


def needed(tree: tuple | int) -> list[tuple | int]:
    """Trees that must all hold for a document to be found."""
    if isinstance(tree, int) or tree[0] == "or":
        return [tree]
    return needed(tree[1]) + (needed(tree[2]) if tree[0] == "and" else [])


def leaves_of(tree: tuple | int) -> set[int]:
    """The leaves without which a tree cannot hold: of NOT, those of its left side."""
    return {tree} if isinstance(tree, int) else leaves_of(tree[1]) | (leaves_of(tree[2]) if tree[0] != "not" else set())


def search(index: DataFrame | SearchIndex, query: str) -> DataFrame:
    """FTS-2, FTS-6: doc for each document that a query finds (its language: `read_query`); a query that cannot be read finds nothing.

    index: postings, or a stored index, of which only the blocks of the query's words are read, and of these those of document ranges
    in which the query's rarest needed part occurs.
    """
    asked = read_query(query)
    if isinstance(index, SearchIndex):
        parts = [] if asked is None else [[asked.leaves[i] for i in leaves_of(t)] for t in needed(asked.tree)]
        index = index.postings([w for w in (asked.leaves if asked else []) if w[0]], [[leaf for leaf in p if leaf[0]] for p in parts])
    if asked is None:
        return index.select("doc").limit(0)
    return hits(index, asked.leaves).filter(holds(asked.tree)).select("doc")


def snippet(text, terms: list[str], n: int = 10, marks: tuple[str, str] = ("[", "]"), dots: str = "…") -> Column:
    """FTS-4: n words around the first hit, hits marked."""
    raw = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    hit = lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}]", "").isin(*[t.lower() for t in terms])
    first = F.coalesce(F.try_element_at(F.filter(F.transform(raw, lambda w, i: F.when(hit(w), i)), lambda i: i.isNotNull()), F.lit(1)), F.lit(0))
    start = F.greatest(first - n // 2, F.lit(0))
    part = F.transform(F.slice(raw, start + 1, n), lambda w: F.when(hit(w), F.concat(F.lit(marks[0]), w, F.lit(marks[1]))).otherwise(w))
    return F.concat(F.when(start > 0, dots).otherwise(""), F.array_join(part, " "), F.when(start + n < F.size(raw), dots).otherwise(""))


def like_any(column, needles: list[str]) -> Column:
    """FTS-5: any needle inside, ASCII case aside."""
    return reduce(lambda a, b: a | b, [column.ilike("%" + n.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%") for n in needles])


def locate(index: DataFrame, queries: DataFrame, docs: DataFrame, k: int = 4, used: int = 4) -> DataFrame:
    """JN-5, FTS-7, SRT-1, LIM-1, LIM-2: queries: key, lead, court (arrays), year, ga; docs: doc, year, ga. The k best documents of each query.

    A candidate has one of the first `used` lead terms and, if there are court terms, one of the first `used` of these;
    score = 3 x lead hits + 2 x court hits - 0.2 x min(years apart, 10) + 100 where the ordinal agrees. All candidates are ranked.
    Hits are terms that are words of the document; if docs has a column text, terms that it contains anywhere (AGG-11).
    """
    side = lambda c, name: queries.select("key", F.explode(F.array_distinct(c)).alias("term"), F.lit(name).alias("side"), F.col(c).alias("_all"))
    asked = side("lead", "lead").unionByName(side("court", "court"))
    asked = asked.withColumn("_head", F.array_contains(F.slice("_all", 1, used), F.col("term"))).drop("_all")
    hits = index.join(asked.select("term").distinct(), "term", "left_semi").select("term", "doc").distinct().join(asked, "term")
    count = lambda s: F.count_if(F.col("side") == s)
    got = hits.groupBy("key", "doc").agg(count("lead").alias("lead_hits"), count("court").alias("court_hits"), F.max((F.col("side") == "lead") & F.col("_head")).alias("_l"), F.max((F.col("side") == "court") & F.col("_head")).alias("_c"))
    got = got.join(queries.select("key", "year", "ga", (F.size("court") > 0).alias("_asks")), "key").filter(F.col("_l") & (F.col("_c") | ~F.col("_asks")))
    if "text" in docs.columns:
        sides = got.select("key", "doc").join(queries.select("key", "lead", "court"), "key").groupBy("doc").agg(F.collect_list(F.struct("key", "lead", "court")).alias("_q"))  # queries at most
        low = docs.select("doc", F.lower("text").alias("_t")).join(sides, "doc")
        inside = lambda side: F.size(F.filter(F.array_distinct(side), lambda t: F.contains(F.col("_t"), t))).cast("long")
        counts = low.select("doc", F.explode(F.transform("_q", lambda q: F.struct(q["key"].alias("key"), inside(q["lead"]).alias("lead_hits"), inside(q["court"]).alias("court_hits")))).alias("c")).select("doc", "c.*")
        got = got.drop("lead_hits", "court_hits").join(counts, ["key", "doc"])
    got = got.join(docs.select("doc", F.col("year").alias("_y"), F.col("ga").alias("_g")), "doc")
    apart = F.least(F.abs(F.coalesce("_y", F.lit(0)) - F.coalesce("year", F.lit(0))), F.lit(10)).cast("double")
    score = F.col("lead_hits") * 3.0 + F.col("court_hits") * 2.0 - apart * F.lit(0.2) + F.when(F.col("ga") == F.col("_g"), 100.0).otherwise(0.0)
    ranked = got.withColumn("score", F.bround(score, 1)).withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "doc")))
    return ranked.filter(F.col("rank") <= k).select("key", "doc", "score", "lead_hits", "court_hits", "rank")


def browse(index: DataFrame, kind: str | None = None, provision: str | None = None, topic: str | None = None) -> DataFrame:
    """FTS-8: the unified index by type, provision and words of the title."""
    out = index
    if kind:
        out = out.filter(F.col("type") == kind)
    if provision:
        out = out.filter(F.array_contains("provisions", provision))
    return out.filter(F.contains(F.lower(F.concat_ws(" ", "title", "sub")), F.lit(topic.lower()))) if topic else out
