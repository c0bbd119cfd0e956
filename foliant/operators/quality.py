"""Text-quality measures and predicates (QC-1 … QC-17)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .repair import despacer

# Abbreviations that count as words.
ABBREVIATIONS = "sjc ccb bco rao pca opc arp epc wcf wlc wsc te re ga gas msc msa mtw mna ac cmc rpr byfc ruf pcus pcusa nae".split()
# The shape of a stray letter, and what is no symbol.
STRAY = r"(?:(?<=\s)|^)[B-HJ-Zb-hj-z](?=\s)"
SYMBOL = r"[^\p{L}\p{N}_\s.,;:'\"()\-/&]"


SMALL = 500_000  # words of a lexicon that goes to the workers whole


@dataclass(frozen=True)
class Limits:
    """The thresholds."""

    fragments: float = 0.25
    recovered: float = 0.85
    reread: float = 0.80
    years: tuple[int, int] = (1973, 2026)
    chapters: tuple[int, int] = (1, 63)


def word_tokens(text) -> Column:
    """Lower-case runs of a-z."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z]+)"), F.lit(1))


def cut(texts: pa.Array, table: bytes) -> tuple[pa.Array, np.ndarray]:
    """The tokens between blanks of all texts in a row, and where each text's begin. Bytes are first put through the table. Ends may have empty tokens."""
    texts = texts.fill_null("").cast("large_string")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    put = (memoryview(texts.buffers()[2])[at[0] : at[-1]].tobytes() if at[-1] else b"").translate(table)
    tokens = pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at - at[0]), pa.py_buffer(put)))
    return tokens.flatten(), np.asarray(tokens.offsets)


def in_parts(measure: Callable[[pa.Array], dict], kind: str) -> Callable[..., Column]:
    """A column function of a text, a struct of that kind: `measure` takes the texts of a batch in Arrow, 256 at a time."""

    def struct(texts: pa.Array) -> pa.Array:
        got = {name: x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for name, x in measure(texts).items()}
        return pa.StructArray.from_arrays(list(got.values()), list(got))

    @F.arrow_udf(kind)
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([struct(texts.slice(at, 256)) for at in range(0, max(len(texts), 1), 256)])

    return measured


def in_each(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[ends])


def letter_words(texts: pa.Array) -> dict:
    """In each text, words that are letters only, and those of one letter. Words stand between blank, tab, \\n, \\f and \\r, as in the SQL."""
    tokens, ends = cut(texts, bytes(c if c != 11 else 95 for c in range(256)))
    letters = np.array(pc.ascii_is_alpha(tokens))
    other = np.flatnonzero(~np.asarray(pc.string_is_ascii(tokens)))
    letters[other] = np.asarray(pc.match_substring_regex(tokens.take(pa.array(other)), r"\A\p{L}+\z"))
    return {"single": in_each(letters & np.asarray(pc.equal(pc.utf8_length(tokens), 1)), ends), "letters": in_each(letters, ends)}


def fragments(text) -> Column:
    """QC-2: one-letter words among the words that are letters only; 0 without any."""
    n = in_parts(letter_words, "struct<single: long, letters: long>")(text)
    return F.coalesce(F.try_divide(n["single"].cast("double"), n["letters"].cast("double")), F.lit(0.0))


def stray_letters(text) -> Column:
    """QC-6: single letters but A and I, with a blank after and a blank or the start before."""
    return F.regexp_count(text, F.lit(STRAY)).cast("long")


def n_words(text) -> Column:
    """QC-7."""
    return F.regexp_count(text, F.lit("[A-Za-z]{2,}")).cast("long")


def symbol_share(text) -> Column:
    """QC-8."""
    return F.regexp_count(text, F.lit(SYMBOL)).cast("double") / F.greatest(F.length(text), F.lit(1)).cast("double")


def known_in(words: pa.Array, least: int) -> Callable[..., Column]:
    """A column function of a lower-case text: struct n_tokens, hits."""
    table = bytes(c if chr(c) in ascii_lowercase else 32 for c in range(256))

    def count(texts: pa.Array) -> dict:
        tokens, ends = cut(texts, table)
        long = np.asarray(pc.greater_equal(pc.binary_length(tokens), least))
        return {"n_tokens": in_each(long, ends), "hits": in_each(np.asarray(pc.is_in(tokens, value_set=words)) & long, ends)}

    return in_parts(count, "struct<n_tokens: long, hits: long>")


def word_counts(df: DataFrame, keys: list[str], text: str, lexicon: DataFrame, least: int = 1) -> DataFrame:
    """keys, n_tokens, hits: tokens of `least` letters and how many of them the lexicon or the abbreviations have; one row or more for the keys.

    lexicon: lower-case `word`. Up to SMALL words it goes to the workers, which count within each text; beyond, tokens are counted within the keys first,
    so what is joined is document vocabularies.
    """
    known = lexicon.select("word").filter("word IS NOT NULL")
    known = known.unionByName(known.sparkSession.createDataFrame([(w,) for w in ABBREVIATIONS], "word string")).distinct()
    words = known.limit(SMALL + 1).toArrow().column("word").cast("large_string").combine_chunks()  # SMALL words at most
    if len(words) <= SMALL:
        return df.select(*keys, known_in(words, least)(F.lower(F.col(text))).alias("_c")).select(*keys, "_c.*")
    tokens = F.filter(word_tokens(F.col(text)), lambda t: F.length(t) >= least)
    each = df.select(*keys, F.explode_outer(tokens).alias("word"))  # a text without tokens has one row without a word
    met = each.groupBy(*keys, "word").agg(F.count("word").alias("n_tokens")).join(known.withColumn("_known", F.lit(1)), "word", "left")
    return met.select(*keys, "n_tokens", F.when(F.col("_known").isNotNull(), F.col("n_tokens")).otherwise(0).alias("hits"))


def hit_rates(df: DataFrame, key: str, text: str, lexicon: DataFrame, least: int = 1, empty: float = 1.0) -> DataFrame:
    """QC-1 (least 1, empty 1.0) and QC-9 (least 2, empty 0.0): key, n_tokens, hit_rate. What is shuffled is one row a document, if the lexicon is small."""
    met = word_counts(df, [key], text, lexicon, least).groupBy(key).agg(F.sum("n_tokens").alias("n_tokens"), F.sum("hits").alias("_hits"))
    return met.select(key, "n_tokens", F.coalesce(F.try_divide("_hits", "n_tokens"), F.lit(empty)).alias("hit_rate"))


def citations(text, limits: Limits = Limits()) -> Column:
    """QC-3: struct present, implausible (arrays), kinds, has_citation."""
    cases = F.regexp_extract_all(text, F.lit(r"((?:19|20)\d{2}-\d{1,3})(?!\d)"), F.lit(1))
    laws = F.regexp_extract_all(text, F.lit(r"(?i)\b(BCO\s*0*\d{1,3}(?:-\d{1,3})?)\b"), F.lit(1))
    odd_case = F.filter(cases, lambda c: ~F.substring(c, 1, 4).cast("int").between(*limits.years))
    odd_law = F.filter(laws, lambda c: ~F.regexp_extract(c, r"(\d+)", 1).cast("int").between(*limits.chapters))
    kinds = F.filter(F.array(F.when(F.size(laws) > 0, F.lit("bco")), F.when(F.size(cases) > 0, F.lit("case"))), lambda k: k.isNotNull())
    present = F.concat(cases, laws)
    return F.struct(present.alias("present"), F.concat(odd_case, odd_law).alias("implausible"), kinds.alias("kinds"), (F.size(present) > 0).alias("has_citation"))


def verdict(frag, hit, despaced, limits: Limits = Limits()) -> Column:
    """QC-4. Where frag is under the trigger, the despaced rate is the rate itself."""
    after = F.when(frag >= limits.fragments, despaced).otherwise(hit)
    return F.when((frag >= limits.fragments) & (after >= limits.recovered), "despace").when((hit < limits.reread) & (after < limits.recovered), "reocr").otherwise("good")


def recovered(terms: dict[str, list[str]], least: float) -> Callable[..., Column]:
    """A column function of a text: struct text, the text despaced; null where fragments are under `least` or nothing is changed."""
    repair = despacer(terms)

    def attempt(texts: pa.Array) -> dict:
        n, out = letter_words(texts), [None] * len(texts)
        for k in np.flatnonzero(n["single"] / np.maximum(n["letters"], 1) >= least):
            was = texts[int(k)].as_py() or ""
            out[k] = now if (now := repair(was)) != was else None
        return {"text": pa.array(out, pa.string())}

    return in_parts(attempt, "struct<text: string>")


def classify(df: DataFrame, key: str, text: str, lexicon: DataFrame, terms: dict[str, list[str]], limits: Limits = Limits()) -> DataFrame:
    """QC-4: key, frag, hit_rate, despaced_rate, verdict: a row for each of df; rates are of all texts of a key. Only texts with enough fragments are despaced,
    and only those that this changes are counted again."""
    frag, t = F.col("frag"), F.col(text)
    tried = df.select(key, t, recovered(terms, limits.fragments)(t).alias("_now"))
    of = lambda kind, c: F.struct(F.lit(kind).alias("_kind"), F.col(c).alias(text))
    each = tried.select(key, F.inline(F.when(F.col("_now.text").isNotNull(), F.array(of("before", text), of("after", "_now.text"))).otherwise(F.array(of("both", text)))))
    n = lambda c, kind: F.sum(F.when(F.col("_kind").isin(kind, "both"), F.col(c)))
    rate = lambda kind: F.try_divide(n("hits", kind), n("n_tokens", kind)).alias(kind)
    rates = word_counts(each, [key, "_kind"], text, lexicon).groupBy(key).agg(rate("before"), rate("after"))
    hit = F.coalesce("before", F.lit(1.0))
    after = F.when(frag >= limits.fragments, F.coalesce("after", F.lit(1.0))).otherwise(hit)
    met = df.select(key, fragments(t).alias("frag")).join(rates, key, "left").select(key, "frag", hit.alias("hit_rate"), after.alias("despaced_rate"))
    return met.withColumn("verdict", verdict(frag, F.col("hit_rate"), F.col("despaced_rate"), limits))


def recoverable(df: DataFrame, key: str, text: str) -> DataFrame:
    """QC-10, AGG-5: key, n_alpha, vowel_share, top_share, recoverable: a row for each of df; no shuffle."""
    start = F.struct(F.lit(None).cast("string").alias("word"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc, w):
        run = F.when(acc["word"] == w, acc["run"] + 1).otherwise(1)
        return F.struct(w.alias("word"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    vowels = F.regexp_count(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit("[b-df-hj-np-tv-z]*+[aeiou][a-z]*+"))  # words with a vowel
    out = df.select(key, F.sort_array(word_tokens(F.col(text))).alias("_t"), vowels.alias("_vowel"))  # equal words stand together
    out = out.select(key, F.size("_t").cast("long").alias("n_alpha"), F.aggregate("_t", start, step, lambda acc: acc["best"]).alias("_top"), "_vowel")
    share = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("n_alpha").cast("double")), F.lit(0.0))
    out = out.select(key, "n_alpha", share("_vowel").alias("vowel_share"), share("_top").alias("top_share"))
    return out.withColumn("recoverable", (F.col("n_alpha") >= 20) & (F.col("vowel_share") >= 0.55) & (F.col("top_share") <= 0.15))


def reread_candidates(pages: DataFrame, key: str, text: str, year: str, lexicon: DataFrame) -> DataFrame:
    """QC-11: the scanned pages with spaces shifted in real text. Cheap column tests come before the joins."""
    t = F.coalesce(F.col(text), F.lit(""))
    few = pages.filter(F.col(year) <= 2002).withColumns({"n_words": n_words(t), "strays": stray_letters(t)})
    few = few.filter((F.col("n_words") >= 40) & (symbol_share(t) < 0.06) & (F.col("strays") >= 5))
    hits = hit_rates(few, key, text, lexicon, least=2, empty=0.0).filter(F.col("hit_rate") >= 0.60)
    sound = recoverable(few, key, text).filter("recoverable")
    return few.join(hits.select(key), key, "left_semi").join(sound.select(key), key, "left_semi").select(key, "strays", "n_words")


def adopt(old_strays, new_strays, old_words, new_words) -> Column:
    """QC-12."""
    return (old_strays >= 5) & (new_strays <= F.greatest(F.lit(2.0), old_strays * 0.5)) & (new_words >= old_words * 0.85)


def strong_location(court_hits, lead_hits) -> Column:
    """QC-13."""
    return (court_hits >= 1) | (lead_hits >= 2)


def acceptable(junk, overmerge, blocks, recall, real) -> Column:
    """QC-14: no overmerge figure counts as failing."""
    return (F.coalesce(junk, F.lit(0)) == 0) & (F.coalesce(overmerge, F.lit(9)) <= 2) & (((blocks >= 3) & (recall >= 0.7)) | ((real >= 15) & (blocks >= 8)))


def short_and_old(text, numbers, year) -> Column:
    """QC-15: drop where short and every number is over five years older."""
    return (F.length(text) < 1000) & (F.size(numbers) > 0) & F.forall(numbers, lambda n: F.substring(n, 1, 4).try_cast("int") < year - 5)


def contains_case(body, numbers, people, provenance, header: str = r"(?i)^#*\s*(?:judicial\s+)?(?:case\s+(?:no\.?\s*)?\d|(?:appeal|complaint|petition|review)\s+of\b)") -> Column:
    """QC-16: decisions are trusted if long or if they name the case; others need a header line that names it."""
    low = F.lower(body)
    named = lambda s: F.exists(numbers, lambda n: F.contains(s, n)) | F.exists(people, lambda p: F.contains(F.lower(s), F.lower(p)))
    decided = F.exists(people, lambda p: F.contains(low, F.lower(p))) | F.exists(numbers, lambda n: F.contains(body, n)) | (F.length(body) > 2000)
    headed = F.exists(F.split(body, "\n"), lambda s: (F.length(F.trim(s)) < 100) & F.trim(s).rlike(header) & named(s))
    return F.when(F.contains(F.coalesce(provenance, F.lit("")), F.lit("decision")), decided).otherwise(headed)


def reads_like_motion(text) -> Column:
    """QC-17."""
    return text.rlike(r"(?i)\bwhereas\b|be it resolved|\btherefore\b|resolved,? that")


def check_pin(df: DataFrame, content: str, pin: str | None) -> DataFrame:
    """QC-5: an error unless each content has the pinned SHA-256; no pin, no check."""
    if pin is None:
        return df
    same = F.sha2(F.col(content), 256) == F.lit(pin)
    return df.filter(F.when(same, F.lit(True)).otherwise(F.raise_error(F.lit("the lexicon differs from its pinned hash"))))
