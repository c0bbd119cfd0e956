"""Many names looked for in many texts at once (JN-20)."""

from __future__ import annotations

import math
import uuid
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = 2_000_000  # of the names that one automaton holds
_built: dict[str, object] = {}


def automaton(key: str, names: list[str]):
    """The names as an Aho-Corasick automaton, built once in a worker; the one before is dropped."""
    import ahocorasick

    if key not in _built:
        _built.clear()
        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for n, name in enumerate(names):
            if name:
                made.add_word(name, n)
        made.make_automaton()
        _built[key] = made
    return _built[key]


def found(texts: DataFrame, doc_id: str, names: list[str]) -> DataFrame:
    """doc_id, _n for each text (column _text) and each name in it, once."""
    kind, key, everywhere = dict(texts.dtypes)[doc_id], uuid.uuid4().hex, [n for n, name in enumerate(names) if not name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = automaton(key, names)
        for batch in batches:
            at, hits = array("q"), array("i")
            for i, text in enumerate(batch.column(1)):  # one text at a time as a Python string
                if (text := text.as_py()) is not None:
                    own = {n for _, n in made.iter(text)} if len(made) else set()
                    own.update(everywhere)
                    at.extend([i] * len(own))
                    hits.extend(sorted(own))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(hits, pa.int32())], [doc_id, "_n"])

    return texts.select(doc_id, "_text").mapInArrow(run, f"`{doc_id}` {kind}, _n int")


def alias_matches(docs: DataFrame, doc_id: str, text: str, aliases: DataFrame, letters: int = LETTERS) -> DataFrame:
    """JN-20: (alias_id, doc) where the lower-case text contains the lower-case alias (alias_id, alias), anywhere, also inside words.

    The aliases go to the workers as an automaton of about `letters` letters at most; where they have more, in several rounds of one pass over the
    texts each. A text is read once a round, however many aliases there are, and no text is shuffled. A null alias or text
    matches nothing, an empty alias every text that is not null; of equal rows of aliases one counts.
    """
    named = aliases.filter("alias is not null").select("alias_id", F.lower("alias").alias("_alias")).distinct()
    names = named.select("_alias").distinct()
    total = names.agg(F.coalesce(F.sum(F.length("_alias")), F.lit(0))).first()[0]
    rounds = max(1, math.ceil(1.2 * total / letters)) if total > letters else 1
    texts, out = docs.select(doc_id, F.lower(F.col(text)).alias("_text")), None
    for k in range(rounds):
        own = sorted(r["_alias"] for r in names.filter(F.pmod(F.xxhash64("_alias"), F.lit(rounds)) == k).collect())  # about `letters` letters
        numbered = docs.sparkSession.createDataFrame(list(enumerate(own)), "_n int, _alias string")
        ids = F.broadcast(numbered.join(named, "_alias").select("_n", "alias_id")) if rounds == 1 and named.limit(100_001).count() <= 100_000 else numbered.join(named, "_alias").select("_n", "alias_id")
        met = found(texts, doc_id, own).join(ids, "_n").select("alias_id", doc_id)
        out = met if out is None else out.unionByName(met)
    return out
