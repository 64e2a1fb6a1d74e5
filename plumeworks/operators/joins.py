"""Join shapes that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup side is broadcast only when a bound on its rows is proven or counted.
BROADCAST_ROWS = 250_000
#: The fewest sub-keys of a salted join.
SALTS = 16


def counted_within(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows; stops reading once it knows."""
    return df.limit(limit + 1).count() <= limit


def salts_for(facts: DataFrame) -> int:
    """Sub-keys of a key, a quarter of the shuffle partitions: the setting that is sized to the data, so a key that holds
    most rows still spans a fair share of the tasks."""
    return max(SALTS, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_lookup_rows: int | None = None,
    salt_on: Sequence[str] = (),
    salts: int | None = None,
) -> DataFrame:
    """Join a large table with a keyed lookup.

    ``max_lookup_rows`` is a bound the caller can prove (e.g. one row per day).
    Within :data:`BROADCAST_ROWS` the lookup is broadcast and the facts are not
    shuffled. Otherwise the facts are spread over ``salts`` sub-keys (by default
    :func:`salts_for`) derived from
    ``salt_on`` (deterministic, so a recomputed task gives the same rows) and
    the lookup is repeated per salt: a hot key then spans several tasks.
    """
    keys = list(on)
    if max_lookup_rows is not None and max_lookup_rows <= BROADCAST_ROWS:
        return facts.join(F.broadcast(lookup), keys, how)
    if not salt_on:
        return facts.join(lookup, keys, how)
    salts = salts or salts_for(facts)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)))
    spread = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")


def with_scalars(df: DataFrame, one_row: DataFrame, prefix: str = "_s") -> DataFrame:
    """Attach a one-row aggregate as a struct column, evaluated once as a scalar subquery."""
    return df.withColumn(prefix, one_row.select(F.struct("*").alias("row")).scalar())
