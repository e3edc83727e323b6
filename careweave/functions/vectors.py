"""Dense vector expressions on ``array<double>`` columns."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from careweave import fixed_values as fv


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(vector: Column) -> Column:
    """Unit vector; a zero vector is divided by a tiny constant and stays zero."""
    length = norm(vector)
    safe = F.when(length == 0, F.lit(fv.ZERO_NORM)).otherwise(length)
    return F.transform(vector, lambda x: x / safe)


def l2_normalize_long(vector: Column) -> Column:
    """``l2_normalize`` for vectors of many elements.

    The length is bound as the value of a one-element array: as a plain expression it is worked out
    again for every element. Not below a Python function, which Spark can't take out of it.
    """
    def scaled(length: Column) -> Column:
        safe = F.when(length == 0, F.lit(fv.ZERO_NORM)).otherwise(length)
        return F.transform(vector, lambda x: x / safe)

    return F.element_at(F.transform(F.array(norm(vector)), scaled), 1)


def argmax(vector: Column) -> Column:
    """Position (from 0) of the first largest element."""
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")


def hyperplanes(count: int, dim: int, seed: int) -> np.ndarray:
    """``count`` fixed directions, by a formula of whole numbers that any SQL engine can follow."""
    n = np.arange(count * dim, dtype=np.int64) + seed * 1_000_003
    x = (n + 1) * 48271 % (2**31 - 1)
    return ((x * x + 12345 * n) % (2**31 - 1) / (2**31 - 1) - 0.5).reshape(count, dim)


def hyperplane_codes(vector: Column, dim: int, tables: int, bits: int, seed: int) -> Column:
    """One code per table: which side of ``bits`` hyperplanes the vector is on.

    Codes of different tables never coincide, so they can share one key column. The Arrow
    function is nested so that it ships by value.
    """
    planes = hyperplanes(tables * bits, dim, seed)

    @F.pandas_udf("array<int>")
    def codes(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        sides = (np.stack(vectors.to_numpy()) @ planes.T >= 0).reshape(-1, tables, bits)
        packed = sides @ (1 << np.arange(bits)) + (np.arange(tables) << bits)
        return pd.Series(list(packed.astype("int32")))

    return codes(vector)
