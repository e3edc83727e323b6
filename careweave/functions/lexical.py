"""Token-overlap scores between a reference text and a generated text."""

from pyspark.sql import Column, functions as F


def unigram_overlap(reference: Column, generated: Column) -> Column:
    """Share of generated tokens that occur in the reference (no clipping, no brevity penalty).

    Takes token array *columns*: an expression would be evaluated once per token of the other.
    """
    found = F.size(F.filter(generated, lambda t: F.array_contains(reference, t)))
    return F.when(F.size(reference) == 0, F.lit(0.0)).otherwise(
        found / F.greatest(F.lit(1), F.size(generated)))


def _lcs_function():
    """Arrow function; nested so that it ships by value and needs nothing installed on workers."""
    import pandas as pd

    @F.pandas_udf("int")
    def lcs(left: pd.Series, right: pd.Series) -> pd.Series:
        def length(a, b):
            # Bit-parallel longest common subsequence (Allison & Dix 1986; Hyyro 2004).
            positions = {}
            for i, token in enumerate(a):
                positions[token] = positions.get(token, 0) | (1 << i)
            full = (1 << len(a)) - 1
            row = full
            for token in b:
                matched = row & positions.get(token, 0)
                row = ((row + matched) | (row - matched)) & full
            return len(a) - row.bit_count()

        return pd.Series([length(a, b) for a, b in zip(left, right)], dtype="int32")

    return lcs


def lcs_length(left: Column, right: Column) -> Column:
    """Length of the longest common subsequence of two token arrays."""
    return _lcs_function()(left, right)


def rouge_l_from(lcs: Column, n_reference: Column, n_generated: Column) -> Column:
    recall = lcs / F.greatest(F.lit(1), n_reference)
    precision = lcs / F.greatest(F.lit(1), n_generated)
    return (F.lit(2.0) * precision * recall) / F.greatest(F.lit(1e-6), precision + recall)
