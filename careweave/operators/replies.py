"""Reply systems and the grounding context they could be given."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.functions import text as tx
from careweave.functions.numbers import shortest_text


def trivial_reply() -> Column:
    return F.lit(fv.TRIVIAL_REPLY)


def nearest_reply(top_response: Column) -> Column:
    """The top case's answer, or a constant where there is none."""
    return F.coalesce(F.nullif(top_response, F.lit("")), F.lit(fv.NEAREST_FALLBACK_REPLY))


def template_reply(
    intent: Column, has_case: Column, templates: Mapping[str, str] = fv.REPLY_TEMPLATES,
    default: str = fv.GENERAL_INTENT,
) -> Column:
    """The intent's template when any case was retrieved, else a constant."""
    filled = F.concat(F.lit(fv.REPLY_PREFIX), tx.mapped(intent, templates, templates[default]))
    return F.when(has_case, filled).otherwise(F.lit(fv.TEMPLATE_FALLBACK_REPLY))


def reply_columns(intent: Column, top_response: Column, has_case: Column) -> dict[str, Column]:
    """One reply per system, keyed by system name."""
    replies = [trivial_reply(), nearest_reply(top_response), template_reply(intent, has_case)]
    return dict(zip(fv.REPLY_SYSTEMS, replies))


def long_replies(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per (row, system) with the reply text."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("system"), F.col(name).alias("generated_reply"))
        for name in fv.REPLY_SYSTEMS])
    return df.select(*keep, F.inline(rows))


def grounding_context(cases: DataFrame, by: str = "query_id") -> DataFrame:
    """Numbered precedents of each query, best first (cases carry at most k rows per query)."""
    block = F.format_string(
        fv.PRECEDENT_FORMAT, F.col("rank").cast("string"),
        shortest_text(F.col("similarity_score")), F.coalesce("case_text", F.lit("")),
        F.coalesce("case_response", F.lit("")))
    return cases.groupBy(by).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("rank"), block.alias("block")))),
        lambda s: s["block"]), "\n\n").alias("context"))


def grounded_prompt(query: Column, intent: Column, context: Column) -> Column:
    head, rest = fv.GROUNDED_PROMPT.split("{query}")
    middle, rest = rest.split("{intent}")
    before_context, tail = rest.split("{context}")
    return F.concat(
        F.lit(head), query, F.lit(middle), intent, F.lit(before_context),
        F.coalesce(context, F.lit(fv.NO_PRECEDENT)), F.lit(tail))
