"""Quality rules by weak supervision.

Each rule looks at one property of a whole text and votes good (1), bad (-1) or abstains (0).
Expectation-maximisation over the counts of the vote patterns estimates, without labels, how common
good texts are and how often each rule is right on good and on bad ones. A text is kept when it passes
the two base checks and its posterior probability of being good reaches the threshold.

Everything that touches texts is a column expression: one scan, no shuffle of texts. What is gathered
is one count per vote pattern, at most 3 ** len(RULES) rows whatever the input; the posterior is again
an expression. Columns of the input are read by name and never renamed, so extra columns do no harm.

* null or empty text: no words, base check failed, not kept. Null doc_id: passed through.
* repeated rows are judged alike, each on its own. An empty table gives an empty result.
* a very long text is one row of arrays of its words and window hashes: memory in proportion to it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import let
from larkspur.llm.common import fresh
from larkspur.session import cut_lineage

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5


def _repeat_words(words: Column) -> Column:
    """Words inside five-word windows that occur twice or more in the array, the first occurrence included."""

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    def places(s: Column) -> Column:
        """Places of the windows whose hash has an equal neighbour in the sorted array, in order."""
        twice = F.transform(s, lambda x, i: F.when(same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)), x["i"]))
        return F.sort_array(F.filter(twice, lambda i: i.isNotNull()))

    def covered(p: Column) -> Column:
        """Words under windows at the sorted places: each window adds those before the next one starts."""
        adds = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(adds, F.lit(0), lambda a, b: a + b)

    def count(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(let(by_hash, places), covered))

    windows = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)]))
    return let(F.slice(windows, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))), count).cast("long")


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def measures(text: Column) -> Column:
    """A struct of counts of one text: what the base checks and the rules look at."""

    def counts(t: Column) -> Column:
        stripped = F.btrim(t, F.lit(SPACE))
        words = F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, r"[\x20\x09-\x0D]+"))
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
        by_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
        by_lines = let(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                F.size(F.filter(x, lambda y: F.substring(F.btrim(y, F.lit(SPACE)), -1, 1).isin(*'.!?"')))
                .cast("long")
                .alias("n_ended_lines"),
                F.size(F.filter(x, lambda y: y.rlike(f"[{SYMBOLS}]"))).cast("long").alias("n_symbol_lines"),
            ),
        )
        return F.struct(
            sum((F.contains(t, F.lit(c)).cast("int") for c in SYMBOLS), F.lit(0)).cast("long").alias("symbol_kinds"),
            _without(t, SPACE).cast("long").alias("word_chars"),
            (F.length(t) - _without(t, SYMBOLS)).cast("long").alias("n_symbols"),
            (F.length(t) - _without(t, UPPER)).cast("long").alias("n_upper"),
            (F.length(t) - _without(t, "!")).cast("long").alias("n_shouts"),
            by_words.alias("w"),
            by_lines.alias("l"),
        )

    def flat(m: Column) -> Column:
        names = ("word_chars", "n_symbols", "symbol_kinds", "n_upper", "n_shouts")
        return F.struct(
            m["w"]["n_words"].alias("n_words"),
            m["w"]["n_repeat_words"].alias("n_repeat_words"),
            m["l"]["n_lines"].alias("n_lines"),
            m["l"]["n_dup_lines"].alias("n_dup_lines"),
            m["l"]["n_ended_lines"].alias("n_ended_lines"),
            m["l"]["n_symbol_lines"].alias("n_symbol_lines"),
            *[m[n].alias(n) for n in names],
        )

    return let(let(F.coalesce(text, F.lit("")), counts), flat)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


#: Name and vote of every rule, over the struct of ``measures``.
RULES: dict[str, Callable[[Column], Column]] = {
    "length": lambda m: _vote(m["n_words"] < 10, m["n_words"] >= 40),
    "symbols": lambda m: _vote(_share(m["n_symbols"], m["n_words"]) > 0.1, _share(m["n_symbols"], m["n_words"]) < 0.02),
    "symbol_lines": lambda m: _vote(_share(m["n_symbol_lines"], m["n_lines"]) > 0.3, m["n_symbol_lines"] == 0),
    "symbol_kinds": lambda m: _vote(m["symbol_kinds"] > 2, m["symbol_kinds"] == 0),
    "repeats": lambda m: _vote(_share(m["n_repeat_words"], m["n_words"]) > 0.2, _share(m["n_repeat_words"], m["n_words"]) < 0.05),
    "dup_lines": lambda m: _vote(_share(m["n_dup_lines"], m["n_lines"]) > 0.5, (m["n_dup_lines"] == 0) & (m["n_lines"] > 2)),
    "capitals": lambda m: _vote(_share(m["n_upper"], m["word_chars"]) > 0.3, _share(m["n_upper"], m["word_chars"]) < 0.1),
    "shouts": lambda m: _vote(_share(m["n_shouts"], m["n_words"]) > 0.1, _share(m["n_shouts"], m["n_words"]) < 0.02),
    "word_length": lambda m: _vote(
        (_share(m["word_chars"], m["n_words"]) < 2.5) | (_share(m["word_chars"], m["n_words"]) > 14),
        _share(m["word_chars"], m["n_words"]).between(3.5, 9),
    ),
    "sentences": lambda m: _vote(_share(m["n_ended_lines"], m["n_lines"]) < 0.2, _share(m["n_ended_lines"], m["n_lines"]) > 0.6),
}


def votes(m: Column) -> Column:
    """A struct with the vote of every rule."""
    return F.struct(*[rule(m).cast("int").alias(name) for name, rule in RULES.items()])


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 200) -> tuple[float, list[tuple[float, float]]]:
    """Share of good texts, and per rule how often its vote is right on good and on bad texts.

    ``patterns`` holds (votes, count). Pseudo-counts say that 7 of 10 texts are good, that a rule rarely
    votes against a good text and that it sees 4 of 10 bad ones, as each looks at one defect only. They
    name the two classes and keep small inputs stable.
    """
    prior, right = 0.7, [(0.95, 0.4)] * rules
    for _ in range(rounds):
        good_n = bad_n = 0.0
        tally = [[9.5, 0.5, 4.0, 6.0] for _ in range(rules)]
        for pattern, count in patterns:
            p = count * posterior(pattern, prior, right)
            good_n, bad_n = good_n + p, bad_n + count - p
            for r, v in enumerate(pattern):
                if v:
                    tally[r][0 if v > 0 else 1] += p
                    tally[r][2 if v < 0 else 3] += count - p
        new = [(t[0] / (t[0] + t[1]), t[2] / (t[2] + t[3])) for t in tally]
        moved = max((abs(a - b) for old, now in zip(right, new) for a, b in zip(old, now)), default=0)
        prior, right = (good_n + 7) / (good_n + bad_n + 10), new
        if moved < 1e-9:
            break
    return prior, right


def _weights(right: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Log odds that a good and a bad vote of each rule add."""
    right = [(min(max(g, 1e-6), 1 - 1e-6), min(max(b, 1e-6), 1 - 1e-6)) for g, b in right]
    return [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in right]


def posterior(pattern: tuple[int, ...], prior: float, right: list[tuple[float, float]]) -> float:
    odds = math.log(prior / (1 - prior)) + sum(w[0] if v > 0 else w[1] for v, w in zip(pattern, _weights(right)) if v)
    return 1 / (1 + math.exp(-odds))


def _posterior_column(ballot: Column, prior: float, right: list[tuple[float, float]]) -> Column:
    odds = F.lit(math.log(prior / (1 - prior)))
    for name, (up, down) in zip(RULES, _weights(right)):
        odds = odds + F.when(ballot[name] > 0, F.lit(up)).when(ballot[name] < 0, F.lit(down)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


def _learn(ballots: DataFrame, ballot: str) -> tuple[float, list[tuple[float, float]]]:
    """Accuracies from the counts of the vote patterns: at most 3 ** len(RULES) rows reach the driver."""
    names = list(RULES)
    rows = ballots.groupBy(*[F.col(ballot)[n].alias(n) for n in names]).agg(F.count(F.lit(1)).alias("pattern_rows")).collect()
    patterns = sorted((tuple(r[n] for n in names), r["pattern_rows"]) for r in rows)
    return estimate(patterns, len(names))


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, the counts, ``base_failed``, ``posterior``, ``kept`` and the votes of every document.

    Counts and votes are computed once and written to the shared folder as a narrow table, from which
    both the estimation and the result are read.
    """
    narrow = docs.select("doc_id", measures(F.col("text")).alias("m"))
    narrow = cut_lineage(narrow.select("doc_id", "m", votes(F.col("m")).alias("ballot")), "quality-rules")
    prior, right = _learn(narrow, "ballot")
    good = _posterior_column(F.col("ballot"), prior, right)
    m = F.col("m")
    return narrow.select(
        "doc_id",
        *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(m).alias("base_failed"),
        (~base_failed(m) & (good >= threshold)).alias("kept"),
        good.alias("posterior"),
        "ballot",
    )


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that ``judge`` keeps, with their columns as they are.

    The texts are written once to the shared folder with the votes beside them: the accuracies are learned from
    the column of votes alone, and the texts are filtered as they are read again.
    """
    m, ballot, failed = fresh(docs, "_measures"), fresh(docs, "_ballot"), fresh(docs, "_failed")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    judged = docs.withColumn(m, measures(F.col("text")))
    voted = cut_lineage(judged.select(*columns, votes(F.col(m)).alias(ballot), base_failed(F.col(m)).alias(failed)), "quality-votes")
    prior, right = _learn(voted, ballot)
    good = _posterior_column(F.col(ballot), prior, right)
    return voted.where(~F.col(failed) & (good >= threshold)).select(*columns)
