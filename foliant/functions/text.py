"""Column functions on names, numbers and keys (FN-1 … FN-27)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The kinds of cited provisions.
KINDS = ("BCO", "RAO", "WCF", "WLC", "WSC", "RONR")


def or_else(value, default) -> Column:
    """value unless it is null or blank (a missing value and an empty one are alike)."""
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), default)


def ordinal(n) -> Column:
    """FN-1: 1st, 2nd, 3rd, 4th, 11th, 112th."""
    last, two = n % 10, n % 100
    suffix = F.when(two.between(10, 20), "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), suffix)


def slugify(text, cap: int = 60, default: str = "report") -> Column:
    """FN-2: runs of other than a-z and 0-9 to one hyphen, at most cap characters."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return or_else(F.substring(plain, 1, cap), F.lit(default))


def safe_file_name(text) -> Column:
    return F.regexp_replace(text, "[^A-Za-z0-9_.-]", "_")


def assembly_of_year(year) -> Column:
    """FN-3: yearly meetings counted from 1973; none in 2020."""
    return F.when(year <= 2019, year - 1972).otherwise(year - 1973)


def year_of_assembly(n) -> Column:
    return F.when(n <= 47, n + 1972).otherwise(n + 1973)


def volume_parts(stem) -> Column:
    """FN-4, FN-23: ga30_2002 as (30, 2002); 0 where there is none."""
    part = lambda g: F.coalesce(F.regexp_extract(stem, r"ga(\d+)_(\d{4})", g).try_cast("int"), F.lit(0))
    return F.struct(part(1).alias("ga_ordinal"), part(2).alias("year"))


def volume_name(raw, known: dict[int, str]) -> Column:
    """FN-9: GA30 or 30 as its volume; anything else passes."""
    number = F.regexp_extract(raw, r"(?i)^(?:ga)?0*(\d+)$", 1).try_cast("int")
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(names, number), raw)


def spaced_title(stem) -> Column:
    """FN-5: 1990-08_Bowen_v_EasternSide as Bowen v. Eastern Side."""
    s = F.regexp_replace(stem, r"^\d{4}-\d{2}[ab]?(?:&-?\d{2})?_?", "")
    s = F.regexp_replace(F.regexp_replace(s, "_vs?_", " v. "), "_", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(s, "(?<=[a-z])(?=[A-Z])", " "), r"\s+", " "))


def markdown_cell(text) -> Column:
    """FN-6."""
    return F.trim(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")))


def topic_key(topic) -> Column:
    """FN-7 (its patterns are fixed values): one key for a topic's articles, report qualifiers, parts and punctuation."""
    k = F.regexp_replace(F.upper(topic), r"^(THE|A|AN)\s+", "")
    k = F.regexp_replace(k, r"\b(MAJORITY|MINORITY|INITIAL|FINAL|PRELIMINARY)\s+REPORT\b", "")
    k = F.regexp_replace(k, r"\bPARTS?\s+[IVX]+(\s*[-–]\s*[IVX]+)?\b", "")
    return F.trim(F.regexp_replace(F.regexp_replace(k, "[^A-Z0-9 ]", " "), r"\s+", " "))


def display_title(topic, acronyms: dict[str, str]) -> Column:
    """FN-8: words capitalised if the topic is all upper or all lower case; acronyms as listed."""
    word = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))
    plain = (topic == F.upper(topic)) | (topic == F.lower(topic))
    words = F.split(F.trim(topic), r"\s+")
    words = F.when(plain, F.transform(words, word)).otherwise(words)
    if acronyms:
        table = F.create_map(*[F.lit(x) for pair in acronyms.items() for x in pair])
        words = F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))
    return F.array_join(words, " ")


def court_of_year(year) -> Column:
    """FN-10: the older body up to 1987."""
    return F.when(F.coalesce(year, F.lit(9999)) <= 1987, "CJB").otherwise("SJC")


def page_label(pages) -> Column:
    """FN-12: p. N or pp. A–B of a sorted array."""
    first, last = F.try_element_at(pages, F.lit(1)), F.try_element_at(pages, F.lit(-1))
    return F.when(F.size(pages) == 0, "see report").when(first == last, F.concat(F.lit("p. "), first.cast("string"))).otherwise(F.concat(F.lit("pp. "), first.cast("string"), F.lit("–"), last.cast("string")))


def assembly_cell(n, year) -> Column:
    """FN-24."""
    return F.when(n.isNotNull() & (n != 0), F.concat(ordinal(n), F.lit(" ("), year.cast("string"), F.lit(")"))).otherwise(F.coalesce(year.cast("string"), F.lit("—")))


def report_link(url, volume, pages, anchor) -> Column:
    """FN-24: the external source if there is one, else the volume's page."""
    own = F.concat(F.lit("["), volume, F.lit(" "), page_label(pages), F.lit("](../markdown/"), volume, F.lit(".md#"), F.coalesce(anchor, F.lit("")), F.lit(")"))
    return F.when(or_else(url, F.lit(None)).isNotNull(), F.concat(F.lit("[external]("), url, F.lit(")"))).otherwise(own)


def haystack(*parts) -> Column:
    """FN-25."""
    return F.lower(F.concat_ws(" ", *parts))


def letters(text) -> Column:
    """FN-26."""
    return F.regexp_replace(text, "[^A-Za-z]", "")


def is_initial(token) -> Column:
    return token.rlike("^[A-Z][.)]?$")


def bare(provision) -> Column:
    """FN-27: a provision without its kind."""
    return F.regexp_replace(provision, "^[A-Z]+ ", "")


def iso_date(text) -> Column:
    """FN-17: a date if text is YYYY-MM-DD."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def valid_number(text, low: int, high: int, prefix: str = "O") -> Column:
    """FN-20: O7 as 7 if within bounds, else null."""
    n = F.regexp_extract(F.upper(F.trim(text)), rf"^{prefix}?0*(\d+)$", 1).try_cast("int")
    return F.when(n.between(low, high), n)


def case_key(raw, suffix: bool = True, pad: int = 0) -> Column:
    """Section 1.4's keys of numbers such as 1990-08, 98-9, 1992-09b, 2017-06&-07: four-digit year,
    number without zeros or padded, a or b kept or not. Null where no number is known."""
    pattern = r"^\D*(\d{2,4})-(\d{1,3})([A-Za-z]?)"
    year, n, letter = (F.regexp_extract(raw, pattern, g) for g in (1, 2, 3))
    century = F.when(year.try_cast("int") >= 70, "19").otherwise("20")
    year = F.when(F.length(year) == 2, F.concat(century, year)).otherwise(year)
    n = n.try_cast("int").cast("string")
    n = F.when(F.length(n) < pad, F.lpad(n, max(pad, 1), "0")).otherwise(n)
    key = F.concat(year, F.lit("-"), n, F.lower(letter) if suffix else F.lit(""))
    return F.when(raw.rlike(pattern), key)


def case_variants(raw) -> Column:
    """FN-22: every way of writing a case number: two or four digits of the year, padded or not."""
    pattern = r"^\D*(\d{2,4})-(\d{1,3})"
    year, n = F.regexp_extract(raw, pattern, 1), F.regexp_extract(raw, pattern, 2).try_cast("int").cast("string")
    other = F.when(F.length(year) == 4, F.substring(year, 3, 2)).when(F.length(year) == 2, F.concat(F.when(year.try_cast("int") >= 70, "19").otherwise("20"), year)).otherwise(year)
    padded = F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n)
    both = lambda y: F.array(F.concat(y, F.lit("-"), n), F.concat(y, F.lit("-"), padded))
    return F.when(raw.rlike(pattern), F.array_sort(F.array_distinct(F.concat(both(year), both(other))))).otherwise(F.array().cast("array<string>"))


def string_key(n) -> Column:
    """SRT-3: numbers in the order of their digits, so that 10 comes before 2."""
    return n.cast("string")


def null_as(value, at: int) -> Column:
    """SRT-5: a sort key that puts nulls where `at` would stand (0 or 99)."""
    return F.coalesce(value, F.lit(at))


def natural_key(text) -> Column:
    """SRT-4: the number in an id, so that O2 comes before O10."""
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("int")


MATCHED = 8  # tokens for which all assignments are tried


def likeness(a, b) -> Column:
    """1 for equal texts, less by each edit, as a share of the longer one."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def bound(value, f) -> Column:
    """f of a value that is worked out once: what a lambda function takes from outside is worked out again at each of its calls."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def party_share(a, b, least: float = 0.7) -> Column:
    """FN-21: how much of the shorter list of names the other has, names that differ by a misreading or so counted by their likeness: the best sum over all ways to
    pair each name with one other, of pairs of `least` likeness or more, by the size of the shorter list; null if a list is empty.

    Equal names are paired first. Of up to MATCHED others all pairings are tried (the best sum for each set of used names); of longer lists each name
    takes the nearest one left.
    """
    near = lambda x, y: bound(likeness(x, y), lambda s: F.when(s >= least, s).otherwise(0.0))

    def tried(few, many):
        rows = F.transform(many, lambda x: F.transform(few, lambda y: near(x, y)))  # likenesses of each of the longer list
        places = F.sequence(F.lit(0), F.size(few) - 1)
        sets = F.sequence(F.lit(0), F.pow(F.lit(2), F.least(F.size(few), F.lit(MATCHED))).cast("int") - 1)
        return bound(F.struct(rows.alias("rows"), places.alias("places"), sets.alias("sets")), best_of)

    def best_of(v):
        def take(best, row):
            """best[s]: the best sum that uses the names of set s at most, after one more row."""
            with_row = lambda s: F.array_max(F.transform(v["places"], lambda j: F.when(F.floor(s / F.pow(F.lit(2), j)) % 2 == 1, F.get(best, s - F.pow(F.lit(2), j).cast("int")) + F.get(row, j)).otherwise(0.0)))
            return F.transform(v["sets"], lambda s: F.greatest(F.get(best, s), F.coalesce(with_row(s), F.lit(0.0))))

        return F.element_at(F.aggregate(v["rows"], F.transform(v["sets"], lambda s: F.lit(0.0)), take), -1)

    def nearest(acc, x):
        best = F.array_max(F.transform(acc["left"], lambda y: F.struct(near(x, y).alias("s"), y.alias("y"))))
        hit = F.coalesce(best["s"], F.lit(0.0)) > 0
        return F.struct(F.when(hit, F.array_remove(acc["left"], best["y"])).otherwise(acc["left"]).alias("left"), (acc["sum"] + F.when(hit, best["s"]).otherwise(0.0)).alias("sum"))

    def rest(few, many):
        greedy = F.aggregate(many, F.struct(few.alias("left"), F.lit(0.0).alias("sum")), nearest, lambda acc: acc["sum"])
        return F.when(F.size(few) == 0, F.lit(0.0)).when(F.size(few) <= MATCHED, tried(few, many)).otherwise(greedy)

    def share(d):
        same, left, right = F.size(F.array_intersect(d["a"], d["b"])), F.array_except(d["a"], d["b"]), F.array_except(d["b"], d["a"])
        sides = bound(F.struct(left.alias("l"), right.alias("r")), lambda v: F.when(F.size(v["l"]) <= F.size(v["r"]), F.struct(v["l"].alias("few"), v["r"].alias("many"))).otherwise(F.struct(v["r"].alias("few"), v["l"].alias("many"))))
        return F.try_divide(same + bound(sides, lambda v: rest(v["few"], v["many"])), F.least(F.size(d["a"]), F.size(d["b"])).cast("double"))

    return bound(F.struct(F.array_distinct(a).alias("a"), F.array_distinct(b).alias("b")), share)
