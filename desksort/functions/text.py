"""Text cleaning as column expressions.

Each function maps a string column to a string column and stays inside the
JVM. NULL counts as empty text throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns

KINDS = tuple(kind for kind, _, _ in patterns.PERSONAL_DATA)


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is named."""
    return F.transform(F.array(value), body)[0]


Test = Callable[[Column], Column]


def holds(literal: str) -> Test:
    return lambda c: F.contains(c, F.lit(literal))


def is_ascii(c: Column) -> Column:
    return F.length(c) == F.octet_length(c)


def may_hold_word(*words: str) -> Test:
    """False where a text of plain ASCII has none of the words in any case;
    other texts have letters that fold to ASCII ones, and always pass."""

    def test(c: Column) -> Column:
        lowered = F.lower(c)
        found = F.contains(lowered, F.lit(words[0]))
        for word in words[1:]:
            found = found | F.contains(lowered, F.lit(word))
        return ~is_ascii(c) | found

    return test


def has_digits(run: str) -> Test:
    """Some run of digits of any script, ``#`` standing for a digit."""
    return lambda c: c.rlike("(?U)" + run.replace("#", r"\d"))


def may_hold_wide_space(c: Column) -> Column:
    """Looks for the characters as bytes, which beats matching their class."""
    found = F.lit(False)
    for space in patterns.WIDE_SPACES:
        found = found | F.contains(c, F.lit(space))
    return ~is_ascii(c) & found


def _rewrite(c: Column, steps: Iterable[tuple[str, str]], needs: Test | None = None) -> Column:
    """Replace matches of each pattern in turn; ``needs`` is a cheap test that
    every text with a match passes, so that the others skip the patterns."""

    def replace(x: Column) -> Column:
        for pattern, replacement in steps:
            x = F.regexp_replace(x, F.lit(pattern), F.lit(replacement))
        return x

    steps = list(steps)
    if needs is None:
        return replace(c)
    return bind(c, lambda x: F.when(needs(x), replace(x)).otherwise(x))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(_column(c).cast("string"), F.lit(""))


def personal_data_steps(
    kinds: Iterable[str] | None = None,
) -> list[tuple[str, str, str, Test]]:
    """(kind, pattern, token, needs) for the chosen kinds, in their fixed order.

    Word boundaries, digits, spaces and case are those of all of Unicode.
    """
    wanted = set(KINDS if kinds is None else kinds)
    if unknown := wanted - set(KINDS):
        raise ValueError(f"unknown personal-data kinds: {sorted(unknown)}")
    three_digits = has_digits("#{3}")
    needs = {
        "email": holds("@"),
        "phone": three_digits,
        "ssn": three_digits,
        "credit_card": three_digits,
        "ip_address": has_digits(r"#\.#"),
        "url": holds("://"),
        "ticket_id": may_hold_word("ticket", "id", "case"),
        "invoice_id": may_hold_word("inv"),
        "user_id": may_hold_word("user", "uid"),
        "account_number": has_digits("#{6}"),
    }
    return [
        (kind, "(?iuU)" + pattern, token, needs[kind])
        for kind, pattern, token in patterns.PERSONAL_DATA
        if kind in wanted
    ]


def redact(c: Column | str, kinds: Iterable[str] | None = None) -> Column:
    """Put a token in place of personal data. Each kind of pattern sees the
    text the one before it left."""
    out = text_or_empty(c)
    # Neighbours with the same test share it.
    for needs, steps in groupby(personal_data_steps(kinds), key=lambda step: step[3]):
        out = _rewrite(out, [(pattern, token) for _, pattern, token, _ in steps], needs)
    return out


def strip_non_printable(c: Column | str) -> Column:
    return _rewrite(text_or_empty(c), [(patterns.NON_PRINTABLE, "")])


def _strip_markup(c: Column, rules: Iterable[tuple[str, str]]) -> Column:
    needs = {r"&#\d+;": holds("&#"), r"<[^>]+>": holds("<")}
    for pattern, replacement in rules:
        if pattern.startswith("&") and pattern not in needs:
            # A plain string: no pattern matching needed.
            c = F.replace(c, F.lit(pattern), F.lit(replacement))
        else:
            c = _rewrite(c, [("(?U)" + pattern, replacement)], needs.get(pattern))
    return c


def strip_markup(c: Column | str) -> Column:
    return _strip_markup(text_or_empty(c), patterns.MARKUP)


def squeeze_noise(c: Column | str) -> Column:
    out = text_or_empty(c)
    for pattern, replacement in patterns.NOISE:
        out = _rewrite(out, [(pattern, replacement)], holds(patterns.NOISE_RUNS[pattern]))
    return out


def collapse_whitespace(c: Column | str) -> Column:
    """Runs of whitespace to one space, none at the ends."""
    # Wide spaces apart: without them the class is one table look-up a character.
    wide = [(f"[{patterns.WIDE_SPACES}]", " ")]
    out = _rewrite(text_or_empty(c), wide, may_hold_wide_space)
    return F.trim(_rewrite(out, [(f"[{patterns.NARROW_SPACES}]+", " ")]))


def lower_case(c: Column | str) -> Column:
    return F.lower(text_or_empty(c))


def is_blank(c: Column | str) -> Column:
    """True where the text is empty or all whitespace."""
    return ~text_or_empty(c).rlike(patterns.NOT_WHITESPACE)


def normalize(c: Column | str) -> Column:
    """Markup, then noise, then whitespace, then lower case."""
    # Line breaks and tabs need no step of their own here: no other step tells
    # them from spaces, and the whitespace step folds them.
    out = squeeze_noise(_strip_markup(text_or_empty(c), patterns.MARKUP[2:]))
    return F.lower(collapse_whitespace(out))


def gate_length(c: Column | str, min_length: int = 10, max_length: int = 2000) -> Column:
    """Blank what is shorter than ``min_length``; cut what is longer than
    ``max_length``."""
    return bind(
        text_or_empty(c),
        lambda x: F.when(F.length(x) < min_length, F.lit("")).otherwise(
            F.substring(x, 1, max_length)
        ),
    )


def clean(
    c: Column | str,
    min_length: int = 10,
    max_length: int = 2000,
    redact_pii: bool = True,
) -> Column:
    """The whole cleaner: printable characters, redaction, normalising, length."""
    out = strip_non_printable(c)
    if redact_pii:
        out = redact(out)
    return gate_length(normalize(out), min_length, max_length)
