"""Governance scans as column expressions: one projection, no UDF in the text path.

A check maps a text column to a verdict struct. ``guard_chain`` feeds each check
the text the previous one left.
"""

from __future__ import annotations

import ast
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions import patterns as P
from larkspur.functions import text as tx
from larkspur.functions.text import let


def unicode(pattern: str, flags: str = "") -> str:
    """Word boundaries, digits and blanks by Unicode rules.

    A pattern that begins with a digit after a word boundary gets a look-ahead for
    the digit, which rejects most positions before the costlier boundary test.
    """
    digit_first = pattern.startswith((r"\b\d", r"\b(\d", r"\b(?:\d"))
    return f"(?U{flags})" + (r"(?=\d)" if digit_first else "") + pattern


# A check turns a text column into struct<safe boolean, text string, violation string>.
Check = Callable[[Column], Column]


def verdict(safe: Column, text: Column, violation: Column) -> Column:
    return F.struct(safe.alias("safe"), text.alias("text"), violation.cast("string").alias("violation"))


def rewrite_matches(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """Replace each match by ``change(match)``; the text between matches stays as it is."""
    between = F.split(text, pattern)
    found = F.concat(F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), change), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, found, lambda a, b: F.concat(a, b)), "")


def any_match(text: Column, pattern: str, test: Callable[[Column], Column]) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    return F.regexp_like(text, F.lit(pattern)) & F.exists(found, test)


def _judge(text: Column, hit: Callable[[Column], Column], cleaned: Callable[[Column], Column], message: str) -> Column:
    state = F.struct(text.alias("text"), hit(text).alias("hit"))
    return let(
        state,
        lambda s: verdict(
            ~s["hit"],
            F.when(s["hit"], cleaned(s["text"])).otherwise(s["text"]),
            F.when(s["hit"], F.lit(message)),
        ),
    )


def _regex_check(pattern: str, mark: str, message: str, needle: str | None = None) -> Check:
    """Redact a pattern. Every match holds ``needle``, so looking for it first is cheap and exact."""
    java = unicode(pattern)

    def replaced(text: Column) -> Column:
        done = F.regexp_replace(text, java, mark)
        return F.when(text.contains(needle), done).otherwise(text) if needle else done

    def judge(text: Column) -> Column:
        """One pass: no match equals its mark, so a text changes exactly if something matched."""
        both = F.struct(text.alias("old"), replaced(text).alias("new"))
        return let(
            both,
            lambda s: verdict(s["old"] == s["new"], s["new"], F.when(s["old"] != s["new"], F.lit(message))),
        )

    return judge


def _in_turn(text: Column, steps: list[Check], separator: str, prefix: str = "") -> Column:
    """Run checks one after the other on one text and join what they report."""

    def advance(state: Column, step: Check) -> Column:
        return let(
            let(state, lambda s: F.struct(s["found"].alias("found"), step(s["text"]).alias("v"))),
            lambda r: F.struct(
                r["v"]["text"].alias("text"),
                F.concat(r["found"], F.array_compact(F.array(r["v"]["violation"]))).alias("found"),
            ),
        )

    state = F.struct(text.alias("text"), F.array().cast("array<string>").alias("found"))
    for step in steps:
        state = advance(state, step)
    return let(
        state,
        lambda s: verdict(
            F.size(s["found"]) == 0,
            s["text"],
            F.when(F.size(s["found"]) > 0, F.concat(F.lit(prefix), F.array_join(s["found"], separator))),
        ),
    )


def email_phone(text: Column) -> Column:
    """Redact e-mail addresses, then phone numbers; both names join with `` & ``."""
    steps = [
        _regex_check(P.EMAIL, "<EMAIL_REDACTED>", "Email", "@"),
        _regex_check(P.PHONE, "<PHONE_REDACTED>", "Phone Number"),
    ]
    return _in_turn(text, steps, " & ", "PII detected: ")


def prompt_leak(text: Column) -> Column:
    """The first listed phrase present is reported; the text stays."""

    def first(lowered: Column) -> Column:
        return F.coalesce(*[F.when(lowered.contains(p.lower()), F.lit(p)) for p in P.LEAK_PHRASES])

    return let(
        F.struct(text.alias("text"), let(F.lower(text), first).alias("phrase")),
        lambda s: verdict(
            s["phrase"].isNull(),
            s["text"],
            F.concat(F.lit("System prompt leak detected: '"), s["phrase"], F.lit("'")),
        ),
    )


def max_length(limit: int) -> Check:
    def check(text: Column) -> Column:
        return _judge(
            text, lambda t: F.length(t) > limit, lambda t: tx.truncated(t, limit), f"Output exceeded {limit} chars"
        )

    return check


def _is_card(match: Column) -> Column:
    digits = F.regexp_replace(match, "[ -]", "")
    return digits.rlike(r"^[0-9]{13,19}$") & F.call_function("luhn_check", digits)


def _rewriting(pattern: str, test: Callable[[Column], Column], mark: str, message: str) -> Check:
    java = unicode(pattern)

    def cleaned(text: Column) -> Column:
        return rewrite_matches(text, java, lambda m: F.when(test(m), F.lit(mark)).otherwise(m))

    return lambda text: _judge(text, lambda t: any_match(t, java, test), cleaned, message)


# Digit groups of 13 to 19 digits that pass the Luhn test.
credit_card = _rewriting(P.CARD, _is_card, "<CREDIT_CARD>", "PII detected: Credit Card")

ssn = _regex_check(P.SSN, "<SSN>", "PII detected: SSN")

_KEY_CHECKS = [_regex_check(p, "<API_KEY>", name, p.split(r"\b")[1].split("[")[0]) for p, name in P.API_KEYS]


def api_key(text: Column) -> Column:
    """Redact provider keys in list order; the message names every provider found."""
    return _in_turn(text, _KEY_CHECKS, ", ", "API key detected: ")


def _is_public_ip(match: Column) -> Column:
    parts = F.split(match, r"\.")
    a, b = (F.get(parts, F.lit(i)).try_cast("int") for i in (0, 1))
    in_range = ~F.exists(parts, lambda p: F.coalesce(p.try_cast("int") > 255, F.lit(True)))
    private = a.isin(10, 127, 0) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168))
    return in_range & ~private


# Private, loopback and impossible addresses stay.
public_ip = _rewriting(P.IPV4, _is_public_ip, "<IP_ADDRESS>", "PII detected: Public IP Address")

PII_CHECKS: tuple[Check, ...] = (credit_card, ssn, api_key, public_ip)


def guard_chain(df: DataFrame, text: str, checks: list[Check]) -> DataFrame:
    """Add ``is_safe``, ``sanitized_text`` and ``violations`` (in check order)."""
    out = df.withColumn("sanitized_text", F.col(text))
    for i, check in enumerate(checks):
        out = out.withColumn(f"__v{i}", check(F.col("sanitized_text"))).withColumn("sanitized_text", F.col(f"__v{i}.text"))
    steps = [f"__v{i}" for i in range(len(checks))]
    found = F.array_compact(F.array(*[F.col(f"{v}.violation") for v in steps])) if steps else F.array().cast("array<string>")
    safe = F.lit(True)
    for v in steps:
        safe = safe & F.col(f"{v}.safe")
    return out.withColumn("violations", found).withColumn("is_safe", safe).drop(*steps)


def python_check(fn: Callable[[str], tuple[bool, str, str | None]]) -> Check:
    """Extension point for a check written in Python; runs Arrow-batched."""

    @F.pandas_udf("safe boolean, text string, violation string")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fn(t) for t in texts], columns=["safe", "text", "violation"])

    return run


def mask_pii(text: Column) -> Column:
    """Mask e-mail, phone, SSN and keys, in that order."""
    for pattern, mark, _ in P.PII:
        text = F.regexp_replace(text, unicode(pattern), mark)
    return text


def detect_pii(text: Column) -> Column:
    """Distinct types found, in pattern order."""
    hits = [F.when(F.regexp_like(text, F.lit(unicode(p))), F.lit(kind)) for p, _, kind in P.PII]
    return F.array_distinct(F.filter(F.array(*hits), lambda h: h.isNotNull()))


def entity_counts(text: Column) -> dict[str, Column]:
    """How many matches of each type a pattern can find (named entities need a model)."""
    return {
        "email": F.regexp_count(text, F.lit(unicode(P.EMAIL))),
        "phone": F.regexp_count(text, F.lit(unicode(P.PHONE))),
        "ssn": F.regexp_count(text, F.lit(unicode(P.SSN))),
        "credit_card": F.size(F.filter(F.regexp_extract_all(text, F.lit(unicode(P.CARD)), 0), _is_card)),
        "ip_address": F.size(F.filter(F.regexp_extract_all(text, F.lit(unicode(P.IPV4)), 0), _is_public_ip)),
    }


def injection_match(text: Column) -> Column:
    """Text of the first listed pattern that matches, or null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, unicode(p, "im"), 0), F.lit("")) for p in P.INJECTION])


# A string of a JSON text with its quotes, and a colon after it if it is a key.
_JSON_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\s*+:)?'


def json_strings(document: Column) -> Column:
    """String values of a JSON text in document order; keys are left out. An unreadable text has none.

    Texts are cut into strings by one pattern and decoded as one array, however deep they are nested.
    """
    readable = F.try_parse_json(document).isNotNull() | F.json_object_keys(document).isNotNull()
    found = F.filter(F.regexp_extract_all(document, F.lit(f"(?s){_JSON_STRING}"), F.lit(0)), lambda s: ~s.endswith(":"))
    values = F.from_json(F.concat(F.lit("["), F.array_join(found, ","), F.lit("]")), "array<string>")
    return F.when(readable, values).otherwise(F.array().cast("array<string>"))


def injection_in_json(document: Column) -> Column:
    """First match over the string values of a nested JSON document."""
    found = F.transform(json_strings(document), injection_match)
    return F.get(F.filter(found, lambda m: m.isNotNull()), F.lit(0))


def safety_findings(df: DataFrame, text: str) -> DataFrame:
    """One row per failed pattern with category and detail."""
    found = [
        F.when(
            F.regexp_like(F.col(text), F.lit(unicode(p))), F.struct(F.lit(c).alias("category"), F.lit(d).alias("detail"))
        )
        for p, c, d in P.SAFETY
    ]
    return df.withColumn("f", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull()))).select(
        *df.columns, "f.category", "f.detail"
    )


def safety_sanitize(text: Column) -> Column:
    for pattern, _, _ in P.SAFETY:
        text = F.regexp_replace(text, unicode(pattern), "[REDACTED]")
    return text


def printable(text: Column) -> Column:
    """Drop control, format, unassigned and separator characters except the blank."""
    return F.regexp_replace(text, r"[\p{C}\p{Z}&&[^ ]]", "")


def denied_term(text: Column) -> Column:
    lowered = F.lower(printable(text))
    return F.coalesce(*[F.when(lowered.contains(t), F.lit(t)) for t in P.DENY_TERMS])


def prompt_is_safe(text: Column) -> Column:
    lowered = F.lower(text)
    safe = F.lit(True)
    for pattern in P.PROMPT_GUARD:
        safe = safe & ~F.regexp_like(lowered, F.lit(unicode(pattern)))
    return safe


def prompt_sanitize(text: Column) -> Column:
    """Drop a leading role prefix and special tokens, then strip."""
    bare = F.regexp_replace(text, r"(?iU)\A(system|assistant|user)\s*:", "")
    return tx.strip(F.regexp_replace(bare, r"<\|[^|]+\|>", ""))


def _code_findings(source: str) -> list[str]:
    try:
        tree = ast.parse(source)
    except (SyntaxError, ValueError) as error:
        return [f"Syntax Error: {error}"]
    bound = [
        (target.id, node.value.value)
        for node in ast.walk(tree)
        if isinstance(node, ast.Assign) and isinstance(node.value, ast.Constant)
        for target in node.targets
        if isinstance(target, ast.Name)
    ]
    return [
        f"Potential hardcoded secret in variable: {name}"
        for name, value in bound
        if isinstance(value, str) and len(value) > 10 and any(s in name.lower() for s in P.SECRET_NAMES)
    ]


def code_findings(source: Column) -> Column:
    """Names bound to a literal secret in Python source, or the syntax error."""

    @F.pandas_udf("array<string>")
    def run(sources: pd.Series) -> pd.Series:
        return sources.map(_code_findings)

    return run(source)
