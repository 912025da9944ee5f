"""Look-up joins against tables of checked size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


def is_small(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most ``rows`` rows and ``size`` bytes of text.

    Reads no more than ``rows + 1`` rows.
    """
    width = F.length(F.to_json(F.struct(*table.columns)).cast("binary"))
    found = (
        table.select(width.alias("b")).limit(rows + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"))
        .first()
    )
    return found["n"] <= rows and found["b"] <= size


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    small: bool | None = None,
    salt: str | None = None,
    salts: int = 64,
) -> DataFrame:
    """Join ``df`` with a look-up table (``left``, ``inner``, ``left_semi`` or
    ``left_anti``). No job runs while the plan is built.

    Without ``small`` Spark chooses: by the sizes it knows beforehand, else by those it
    has measured when the look-up table has been made, so that a small one is broadcast.
    ``small`` says that the caller has bounded the table (or, if false, that it must not
    be broadcast). ``salt`` then names an integer column of ``df`` (a row number) which
    spreads the rows of a hot key over ``salts`` tasks; without it the split of skewed
    partitions is left to adaptive execution.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if small:
        return df.join(F.broadcast(table), keys, how)
    if small is None or salt is None:
        return df.join(table, keys, how)
    spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("_salt", F.pmod(F.col(salt), F.lit(salts)).cast("int"))
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")
