"""Reading scores, tags and JSON judgements out of model output texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.text import strip


def _clamped(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def _last_tag(text: Column, tag: str) -> Column:
    """Value of the last line that starts with the tag, or null."""
    lines = F.transform(F.split(text, "\n"), strip)
    tagged = F.filter(lines, lambda s: s.startswith(tag))
    return F.when(F.size(tagged) > 0, strip(F.replace(F.element_at(tagged, -1), F.lit(tag), F.lit(""))))


def parse_tagged(text: Column) -> Column:
    """Struct of answer, confidence and reasoning from ``Answer:`` / ``Confidence:`` / ``Reasoning:`` lines.

    A bad or absent number is 0.5, the range is 0..1, a missing answer is the whole text.
    """
    answer = F.nullif(_last_tag(text, "Answer:"), F.lit(""))
    number = _last_tag(text, "Confidence:").try_cast("double")
    reasoning = F.nullif(_last_tag(text, "Reasoning:"), F.lit(""))
    return F.struct(
        F.coalesce(answer, text).alias("answer"),
        _clamped(F.coalesce(number, F.lit(0.5))).alias("confidence"),
        F.coalesce(reasoning, F.lit("Based on provided context")).alias("reasoning"),
    )


def parse_score(text: Column, scale: float = 1.0) -> Column:
    """A score text as a number in 0..1; unreadable is 0.5. ``scale=10`` reads 0 to 10."""
    return _clamped(F.coalesce(strip(text).try_cast("double") / scale, F.lit(0.5)))


def expansion_lines(text: Column) -> Column:
    """Non-blank lines of a query expansion without list marks."""
    lines = F.transform(F.split(text, "\n"), lambda s: F.regexp_replace(s, r"^[\s\-]+|[\s\-]+$", ""))
    return F.filter(lines, lambda s: s != "")


JUDGEMENT = "is_grounded boolean, faithfulness_score double, unsupported_claims array<string>, citations array<string>"


def parse_judgement(text: Column) -> Column:
    """JSON judgement as a struct; null when unreadable or its score is outside 0..1."""
    parsed = F.from_json(text, JUDGEMENT)
    return F.when(parsed["faithfulness_score"].between(0.0, 1.0), parsed)
