"""Text column expressions: all JVM-side, no user functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from careweave import fixed_values as fv

# Whitespace as Unicode text handling counts it: as a pattern class (two quick tests per
# character) and, for trimming, as the characters themselves.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
_SPACES = " " + "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WORD = r"(?U)\w{2,}"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(_SPACES))


def normalize_missing(text: Column) -> Column:
    """Null and spelled-out missing values become the empty string; the rest is stripped."""
    stripped = strip(F.coalesce(text.cast("string"), F.lit("")))
    return F.when(stripped.isin(fv.MISSING_WORDS), F.lit("")).otherwise(stripped)


def clean_text(text: Column) -> Column:
    """URLs to a placeholder, handles dropped, whitespace collapsed and stripped (in this order).

    Plain substring tests on the raw text decide whether a pattern has to run at all.
    """
    raw = F.coalesce(text, F.lit(""))
    maybe_url = raw.contains("://") | raw.contains("www.")
    out = F.when(maybe_url, F.regexp_replace(
        raw, "(?U)" + fv.URL_PATTERN, fv.URL_PLACEHOLDER)).otherwise(raw)
    out = F.when(raw.contains("@"), F.regexp_replace(out, fv.HANDLE_PATTERN, "")).otherwise(out)
    return F.trim(F.regexp_replace(out, SPACE + "+", " "))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that each is evaluated once per row.

    A filter on a plain projected column is pushed below the projection and evaluates its
    expression again; the output of a generator stays where it is.
    """
    return df.select("*", F.inline(F.array(F.struct(*[
        value.alias(name) for name, value in columns.items()]))))


def text_key(text: Column) -> Column:
    """Key under which two texts count as the same: stripped and lower-cased."""
    return F.lower(strip(F.coalesce(text, F.lit(""))))


def tokens(text: Column) -> Column:
    """Whitespace tokens; an empty array for blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def token_count(text: Column) -> Column:
    return F.size(tokens(text))


def clean_token_count(cleaned: Column) -> Column:
    """Token count of text that is already clean (single spaces): no pattern needed."""
    return F.when(cleaned == "", F.lit(0)).otherwise(
        F.length(cleaned) - F.length(F.replace(cleaned, F.lit(" "), F.lit(""))) + 1)


def words(text: Column) -> Column:
    """Lower-cased runs of two or more word characters: the feature tokens."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def _has(lowered: Column, keyword: str, whole_word: bool) -> Column:
    if whole_word:
        return lowered.rlike(r"(?U)\b\Q" + keyword.lower() + r"\E\b")
    return lowered.contains(keyword.lower())


def contains_any(text: Column, keywords: Sequence[str], *, whole_word: bool = False) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return _any([_has(lowered, keyword, whole_word) for keyword in keywords])


def keyword_hits(text: Column, keywords: Sequence[str], *, whole_word: bool = False) -> Column:
    """Array of the keywords found, in list order (substring test unless ``whole_word``)."""
    if not keywords:
        return F.array().cast("array<string>")
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*[
        F.when(_has(lowered, keyword, whole_word), F.lit(keyword.lower())) for keyword in keywords
    ]))


def keyword_label(
    text: Column,
    rules: Mapping[str, Sequence[str]] = fv.KEYWORD_RULES,
    default: str = fv.GENERAL_INTENT,
) -> Column:
    """Label of the first rule with a hit, else the default."""
    out = F.lit(default)
    for label, keywords in reversed(list(rules.items())):
        out = F.when(contains_any(text, keywords), F.lit(label)).otherwise(out)
    return out


def keyword_vote_share(
    text: Column,
    rules: Mapping[str, Sequence[str]] = fv.KEYWORD_RULES,
    no_hit: float = fv.UNTRAINED_CONFIDENCE,
) -> Column:
    """Share of all keyword hits that belong to the rule that won; ``no_hit`` without any."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    counts = {
        label: sum((lowered.contains(k.lower()).cast("int") for k in keywords), F.lit(0))
        for label, keywords in rules.items()
    }
    total = sum(counts.values(), F.lit(0))
    out = F.lit(no_hit)
    for label in reversed(list(counts)):
        out = F.when(counts[label] > 0, counts[label].cast("double") / total).otherwise(out)
    return out


def pick(values: Sequence, index: Column) -> Column:
    """Element ``index`` (from 0) of a short constant list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def mapped(key: Column, mapping: Mapping[str, object], default: object) -> Column:
    """Constant lookup as a CASE expression."""
    out = None
    for name, value in mapping.items():
        out = (F.when(key == name, F.lit(value)) if out is None
               else out.when(key == name, F.lit(value)))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))
