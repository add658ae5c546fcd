"""Text helpers as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words a search ignores.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "had", "has", "have",
    "he", "her", "his", "i", "in", "is", "it", "its", "my", "no", "not", "of", "on", "or", "our",
    "she", "so", "that", "the", "their", "them", "they", "this", "to", "was", "we", "were", "will",
    "with", "you", "your",
)

# Phrases that decide the class of a service note.
CHURN_PHRASES = ("not resolved", "threatening to leave", "no service since", "down twice", "will cancel")
HEALTHY_PHRASES = ("routine support call, resolved", "satisfied, no issues")

# Words that make a return comment angry / mild.
ANGRY_WORDS = ("terrible", "unacceptable", "worthless", "furious", "leave", "cancel", "not resolved")
CALM_WORDS = ("satisfied", "routine", "thank", "fine")

_WORD = "[a-z0-9]+"


def raw_words(col: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(f"({_WORD})"), 1)


def search_words(col: Column) -> Column:
    """Lower-case words without stop words, in text order."""
    return F.filter(raw_words(col), lambda w: ~w.isin(*STOP_WORDS))


def query_words(text: str) -> list[str]:
    return [w for w in re.findall(_WORD, text.lower()) if w not in STOP_WORDS]


def search_clauses(query: str) -> list[list[tuple[bool, list[str]]]]:
    """A web-style query as OR-groups of (wanted, words): ``a b or "c d" -e``."""
    groups: list[list[tuple[bool, list[str]]]] = [[]]
    for part in re.findall(r'-?"[^"]*"|\S+', query):
        if part.lower() == "or":
            groups.append([])
            continue
        words = query_words(part)
        if words:
            groups[-1].append((not part.startswith("-"), words))
    return [g for g in groups if g]


def words_match(words: Column, query: str) -> Column:
    """True where the words of a text satisfy the query; an empty query matches nothing."""
    groups = search_clauses(query)
    if not groups:
        return F.lit(False)

    def satisfied(normal: Column) -> Column:
        result = F.lit(False)
        for group in groups:
            hit = F.lit(True)
            for wanted, part in group:
                found = normal.contains(f" {' '.join(part)} ")
                hit = hit & (found if wanted else ~found)
            result = result | hit
        return result

    # A blank around every word makes a phrase a plain substring; bound once, tested often.
    normal = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    return F.exists(F.array(normal), satisfied)


def matches_query(text: Column, query: str) -> Column:
    return words_match(search_words(text), query)


def wanted_words(query: str) -> list[str]:
    """The distinct words a hit is scored on."""
    return list(dict.fromkeys(
        w for g in search_clauses(query) for wanted, words in g if wanted for w in words))


def contains_any(col: Column, phrases) -> Column:
    low = F.lower(col)
    hit = F.lit(False)
    for p in phrases:
        hit = hit | low.contains(p)
    return hit


def note_class(note: Column) -> Column:
    return (F.when(contains_any(note, CHURN_PHRASES), "churn_signal")
            .when(contains_any(note, HEALTHY_PHRASES), "healthy")
            .otherwise("at_risk"))


def anger_score(comment: Column) -> Column:
    return (F.when(contains_any(comment, ANGRY_WORDS), F.lit(1.0))
            .when(contains_any(comment, CALM_WORDS), F.lit(0.0))
            .otherwise(F.lit(0.5)))


def ellipsis(col: Column, width: int, mark: str = "…") -> Column:
    """Cut only what is longer than ``width``."""
    return F.when(F.length(col) > width, F.concat(F.substring(col, 1, width), F.lit(mark))).otherwise(col)


def name_parts(full: Column) -> tuple[Column, Column]:
    """First token, and the rest joined by single blanks (empty for one token)."""
    parts = F.split(F.trim(full), r"\s+")
    return parts[0], F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), " ")


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def entity_id(message: Column, prefix: str = "SUB-") -> Column:
    """First blank-separated token that starts with the prefix, stripped of ``.,;:``; NULL if none."""
    token = F.regexp_extract(message, rf"(?:^|\s)({prefix}\S*)", 1)
    clean = F.regexp_replace(token, r"[.,;:]+$", "")
    return F.when(token == "", F.lit(None).cast("string")).otherwise(clean)


def repair_mojibake(col: Column) -> Column:
    """Undo UTF-8 bytes that were read as Latin-1; text that is not such a misreading is kept."""
    latin = F.when(col.rlike(r"^[\x{00}-\x{FF}]*$"), col)
    again = F.encode(latin, "ISO-8859-1").cast("string")
    return F.when(latin.isNotNull() & F.is_valid_utf8(again), again).otherwise(col)


def to_number(raw: Column) -> Column:
    """Number of a clean numeric string (sign, digits, decimals); NULL for anything else."""
    return F.when(raw.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), raw.try_cast("double"))
