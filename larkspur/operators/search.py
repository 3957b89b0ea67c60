"""Full-text and fuzzy search by one query over a table: linear scans that end in a top-n."""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import let
from larkspur.session import cut_lineage

# Weight of field classes A to D.
FIELD_WEIGHTS = {"A": 1.0, "B": 0.4, "C": 0.2, "D": 0.1}
K1, B = 1.2, 0.75


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def bm25(
    df: DataFrame,
    fields: dict[str, str],
    terms: list[str],
    phrases: list[str] = (),
    without: list[str] = (),
    key: str = "doc_id",
    page: int = 1,
    page_size: int = 25,
) -> DataFrame:
    """Rows holding all terms and phrases and no excluded word, ranked by weighted BM25.

    ``fields`` maps a text column to its class A to D. Each text is split once per
    pass, into counts of the asked terms only. The corpus statistics are one
    aggregate, read back as a scalar; no posting list is built or shuffled.
    """
    terms = [t.lower() for t in terms]
    needles = [" " + " ".join(p.lower().split()) + " " for p in phrases]

    def facts(split: Column) -> Column:
        """What the query needs to know of a row, from its split fields."""
        lists = [split[f] for f in fields]

        def anywhere(test) -> Column:
            return reduce(lambda a, b: a | b, [test(words) for words in lists])

        def frequency(term: str) -> Column:
            hits = [F.size(F.filter(split[f], lambda w: w == term)) * F.lit(FIELD_WEIGHTS[c]) for f, c in fields.items()]
            return reduce(lambda a, b: a + b, hits)

        tests = [anywhere(lambda ws, n=n: F.concat(F.lit(" "), F.array_join(ws, " "), F.lit(" ")).contains(n)) for n in needles]
        tests += [~anywhere(lambda ws, w=w: F.array_contains(ws, w.lower())) for w in without]
        tests += [anywhere(lambda ws, t=t: F.array_contains(ws, t)) for t in terms]
        return F.struct(
            reduce(lambda a, b: a + b, [F.size(words) for words in lists]).alias("length"),
            F.array(*[frequency(t) for t in terms]).alias("tf"),
            reduce(lambda a, b: a & b, tests, F.lit(True)).alias("matches"),
        )

    split = F.struct(*[tokens(F.coalesce(F.col(f), F.lit(""))).alias(f) for f in fields])
    row = let(split, facts)
    stats = df.select(row.alias("m")).agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.avg("m.length").alias("avg_length"),
            F.array(*[F.count_if(F.col("m.tf")[i] > 0) for i in range(len(terms))]).alias("seen"),
        )
    )
    # Exploding the filtered one-row array keeps the test from being pushed below and evaluated twice.
    matching = df.select("*", F.explode(F.filter(F.array(row), lambda m: m["matches"])).alias("m"))
    matching = matching.withColumn("s", stats.scalar())
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, seen = F.col("m.tf")[i], F.col("s.seen")[i]
        idf = F.log(1 + (F.col("s.n") - seen + 0.5) / (seen + 0.5))
        relative = 1 - B + B * F.col("m.length") / F.col("s.avg_length")
        score = score + idf * tf * (K1 + 1) / (tf + K1 * relative)
    return (
        matching.withColumn("score", F.round(score, 9))
        .select(*df.columns, "score")
        .orderBy(F.desc("score"), key)
        .offset((page - 1) * page_size)
        .limit(page_size)
    )


class Conjunct(NamedTuple):
    """What must stand in a row, and what must not: words, and phrases as tuples of words."""

    wanted: tuple[tuple[str, ...], ...]
    unwanted: tuple[tuple[str, ...], ...]


def web_query(text: str) -> list[Conjunct]:
    """A search string as alternatives: words are required, quotes make a phrase, a minus excludes, ``or`` parts alternatives.

    Signs inside a word part it like a text's words, into a phrase. An unclosed quote runs to the end. Alternatives
    without anything in them are left out.
    """
    out = []
    wanted: list[tuple[str, ...]] = []
    unwanted: list[tuple[str, ...]] = []
    for minus, quoted, bare in re.findall(r'(-?)(?:"([^"]*)"?|([^\s"]+))', text):
        if not minus and bare.lower() == "or":
            out.append(Conjunct(tuple(dict.fromkeys(wanted)), tuple(dict.fromkeys(unwanted))))
            wanted, unwanted = [], []
            continue
        words = tuple(w for w in re.split(r"[\W_]+", (quoted or bare).lower()) if w)
        if words:
            (unwanted if minus else wanted).append(words)
    out.append(Conjunct(tuple(dict.fromkeys(wanted)), tuple(dict.fromkeys(unwanted))))
    return [c for c in out if c.wanted or c.unwanted]


def _occurrences(split: Column, fields: dict[str, str], terms: list[tuple[str, ...]]) -> Column:
    """Where the terms end, in order: (start, end, term, inverse weight); positions go on from field to field."""
    kind = "array<struct<start: int, end: int, term: int, inverse: double>>"

    def of_field(words: Column, before: Column, inverse: float) -> Column:
        def at(word: Column, i: Column) -> Column:
            found = []
            for number, term in enumerate(terms):
                hit = word == term[-1]
                for back, other in enumerate(reversed(term[:-1]), 1):
                    hit = hit & (F.get(words, i - back) == other)
                start = (before + i - len(term) + 1).alias("start")
                place = F.struct(start, (before + i).alias("end"), F.lit(number).alias("term"), F.lit(inverse).alias("inverse"))
                found.append(F.when(hit, F.array(place)).otherwise(F.array().cast(kind)))
            return F.concat(*found)

        return F.flatten(F.transform(words, at))

    parts, before = [], F.lit(0)
    for field, weight in fields.items():
        parts.append(of_field(split[field], before, 1 / FIELD_WEIGHTS[weight]))
        before = before + F.size(split[field])
    return F.concat(*parts)


def cover_density(occurrences: Column, alternatives: list[tuple[Column, list[int]]], terms: int) -> Column:
    """Sum over the shortest stretches that hold all terms of an alternative, in one pass over the occurrences.

    A stretch ends where the latest beginning of a satisfied alternative moves on: the smallest of the last places of
    its terms. It adds its occurrences divided by the sum of their inverse weights, and by one plus the places in it
    that are none. ``alternatives`` are (whether it counts in this row, numbers of its terms).
    """
    place = "struct<start: int, nth: int, before: double>"
    none = F.lit(None).cast(place)
    start = F.struct(
        F.array(*[none] * terms).alias("last"), F.lit(0).alias("nth"), F.lit(0.0).alias("inverse"), F.lit(-1).alias("begun"), F.lit(0.0).alias("score")
    )

    def step(a: Column, o: Column) -> Column:
        here = F.struct(o["start"].alias("start"), a["nth"].alias("nth"), a["inverse"].alias("before"))
        last = F.transform(a["last"], lambda x, i: F.when(i == o["term"], here).otherwise(x))

        def found(seen: Column) -> Column:
            begins = []
            for counts, numbers in alternatives:
                places = [seen[n] for n in numbers]
                all_seen = reduce(lambda x, y: x & y, [p.isNotNull() for p in places], counts)
                begins.append(F.when(all_seen, F.least(*places) if len(places) > 1 else places[0]))
            return F.struct(seen.alias("last"), (F.greatest(*begins) if len(begins) > 1 else begins[0]).alias("begin"))

        def added(x: Column) -> Column:
            begin = x["begin"]
            entries, inverse = a["nth"] - begin["nth"] + 1, a["inverse"] + o["inverse"] - begin["before"]
            noise = F.greatest(o["end"] - begin["start"] + 1 - entries, F.lit(0))
            fresh = F.coalesce(begin["start"] > a["begun"], F.lit(False))
            return F.struct(
                x["last"].alias("last"),
                (a["nth"] + 1).alias("nth"),
                (a["inverse"] + o["inverse"]).alias("inverse"),
                F.when(fresh, begin["start"]).otherwise(a["begun"]).alias("begun"),
                (a["score"] + F.when(fresh, entries / inverse / (1 + noise)).otherwise(0.0)).alias("score"),
            )

        return let(let(last, found), added)

    return F.aggregate(occurrences, start, step)["score"]


def web_search(
    df: DataFrame, fields: dict[str, str], query: str, key: str = "doc_id", page: int = 1, page_size: int = 25, max_words: int = 50
) -> DataFrame:
    """A page of the rows that match a search string: ``key``, rank, headline, total.

    ``fields`` maps a text column to its class A to D. Rank is the cover density; equal ranks go by key. A query
    without a word, and a page beyond the last, are empty. Texts are split and judged once; key, hash and rank of the
    matches are written, the page is taken from these, and headlines are made for its rows.
    """
    alternatives = web_query(query)
    terms = list(dict.fromkeys(t for c in alternatives for t in (*c.wanted, *c.unwanted)))
    if not terms:
        return df.select(key, F.lit(0.0).alias("rank"), F.lit("").alias("headline"), F.lit(0).cast("long").alias("total")).limit(0)
    numbers = {t: n for n, t in enumerate(terms)}

    def facts(split: Column) -> Column:
        def judged(occurrences: Column) -> Column:
            present = lambda t: F.exists(occurrences, lambda o: o["term"] == numbers[t])
            free = [reduce(lambda a, b: a & b, [~present(t) for t in c.unwanted], F.lit(True)) for c in alternatives]
            whole = [reduce(lambda a, b: a & b, [present(t) for t in c.wanted], f) for c, f in zip(alternatives, free)]
            scored = [(f, [numbers[t] for t in c.wanted]) for c, f in zip(alternatives, free) if c.wanted]
            rank = cover_density(occurrences, scored, len(terms)) if scored else F.lit(0.0)
            return F.struct(reduce(lambda a, b: a | b, whole).alias("matches"), rank.alias("rank"))

        return let(_occurrences(split, fields, terms), judged)

    split = F.struct(*[tokens(F.coalesce(F.col(f), F.lit(""))).alias(f) for f in fields])
    found = df.select("*", F.explode(F.filter(F.array(let(split, facts)), lambda m: m["matches"])).alias("m"))
    words = sorted({w for c in alternatives for t in c.wanted for w in t}, key=lambda w: (-len(w), w))
    text = F.concat_ws(" | ", *[F.col(f) for f in fields])
    shown = headline(text, [re.escape(w) for w in words], max_words) if words else text
    row = F.xxhash64(*fields).alias("__row")
    ranked = cut_lineage(found.select(key, row, F.round("m.rank", 9).alias("rank")), "search-ranks")
    order = [F.desc("rank"), F.col(key)]
    best = ranked.orderBy(*order, "__row").offset((page - 1) * page_size).limit(page_size)
    # The texts of the page only: its rows, at most ``page_size``, are sent to them.
    names = [key, "__row"]
    texts = df.select(key, row, shown.alias("headline")).join(F.broadcast(best.select(names).distinct()), names, "left_semi").dropDuplicates(names)
    total = ranked.agg(F.count(F.lit(1))).scalar()
    return best.join(texts, names).orderBy(*order).select(key, "rank", "headline", total.alias("total"))


def headline(text: Column, terms: list[str], max_words: int = 50) -> Column:
    """Up to ``max_words`` words from the first term on, with the terms marked."""
    alternatives = "|".join(terms)
    start = F.regexp_instr(text, F.lit(rf"(?iU)\b({alternatives})\b"))
    tail = F.greatest(start, F.lit(1))
    shown = F.array_join(F.slice(F.split(F.substring(text, tail, F.length(text)), r"\s+"), 1, max_words), " ")
    return F.regexp_replace(shown, rf"(?iU)\b({alternatives})\b", "<b>$1</b>")


def trigrams(text: Column) -> Column:
    """Distinct trigrams of the words, each padded with two blanks before and one after."""
    padded = F.transform(
        F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""),
        lambda w: F.concat(F.lit("  "), w, F.lit(" ")),
    )
    grams = F.transform(
        padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3)))
    )
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(a: Column, b: Column) -> Column:
    left, right = trigrams(a), trigrams(b)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(left, right)), F.size(F.array_union(left, right))), F.lit(0.0))


def fuzzy_search(df: DataFrame, text: Column, query: str, key: str, at_least: float = 0.3, limit: int = 10) -> DataFrame:
    """The rows most similar to ``query``: one projection and a top-n, no join."""
    score = F.round(trigram_similarity(text, F.lit(query)), 6)
    return df.withColumn("score", score).where(F.col("score") > at_least).orderBy(F.desc("score"), key).limit(limit)
