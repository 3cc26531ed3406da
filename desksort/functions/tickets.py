"""Ticket fields as column expressions: titles, priorities, categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import taxonomy
from .text import text_or_empty


def cross_fill(title: Column, description: Column, title_chars: int = 100) -> tuple[Column, Column]:
    """An empty title takes the start of the description; an empty description
    takes the title."""
    return (
        F.when(title == "", F.substring(description, 1, title_chars)).otherwise(title),
        F.when(description == "", title).otherwise(description),
    )


def combined_text(title: Column, description: Column) -> Column:
    return F.concat(text_or_empty(title), F.lit(" "), text_or_empty(description))


def normalize_priority(
    c: Column,
    spellings: Mapping[str, Sequence[str]] = taxonomy.PRIORITY_SPELLINGS,
    default: str = taxonomy.DEFAULT_PRIORITY,
) -> Column:
    lowered = F.lower(c.cast("string"))
    out = F.lit(default)
    for level, names in reversed(spellings.items()):
        out = F.when(lowered.isin(*names), F.lit(level)).otherwise(out)
    return out


def keyword_score(lowered: Column, keywords: Sequence[str]) -> Column:
    """Sum, over the keywords the text contains, of their number of words."""
    score = F.lit(0)
    for word in keywords:
        score = score + F.when(F.contains(lowered, F.lit(word)), len(word.split())).otherwise(0)
    return score


def keyword_category(
    lowered: Column,
    keywords: Mapping[str, Sequence[str]] = taxonomy.KEYWORDS,
    categories: Sequence[str] = taxonomy.CATEGORIES,
    fallback: str = taxonomy.GENERAL,
) -> Column:
    """Best-scoring category of a lower-cased text; taxonomy order breaks ties;
    no hit at all gives ``fallback``.

    Score and rank share one integer, so the winner is a single ``greatest``:
    the fallback enters with score 0 and the top rank, and so wins only when
    every score is 0.
    """
    scored = [c for c in categories if c in keywords]
    names = [*reversed(scored), fallback]
    rank = {name: i for i, name in enumerate(names)}
    base = len(names)
    entries = [keyword_score(lowered, keywords[c]) * base + rank[c] for c in scored]
    best = F.greatest(*entries, F.lit(rank[fallback])) % base
    winner = F.element_at(F.array(*[F.lit(n) for n in names]), (best + 1).cast("int"))
    return F.coalesce(winner, F.lit(fallback))


def fragment_category(
    original: Column,
    fragments: Sequence[tuple[str, Sequence[str]]] = taxonomy.CATEGORY_FRAGMENTS,
) -> Column:
    """Category of the first fragment, in listed order, that the lower-cased
    name contains; NULL where none does."""
    lowered = F.lower(original.cast("string"))
    out = F.lit(None).cast("string")
    # Consecutive fragments of one category need only one branch.
    for category, words in reversed(fragments):
        hit = F.contains(lowered, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.contains(lowered, F.lit(word))
        out = F.when(hit, F.lit(category)).otherwise(out)
    return out


def map_category(
    original: Column,
    lowered_text: Column,
    fragments: Sequence[tuple[str, Sequence[str]]] = taxonomy.CATEGORY_FRAGMENTS,
    keywords: Mapping[str, Sequence[str]] = taxonomy.KEYWORDS,
) -> Column:
    return F.coalesce(
        fragment_category(original, fragments), keyword_category(lowered_text, keywords)
    )
