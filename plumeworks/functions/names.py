"""Column-name handling. All of it happens on ``df.columns``, so it costs no job."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


_RUN = re.compile("[a-z0-9]+")


def clean_name(name: str) -> str:
    """The runs of letters and digits in lower case, joined by ``_``."""
    return "_".join(_RUN.findall(name.lower()))


def clean_names(names: Iterable[str]) -> list[str]:
    """Clean every name; names that collide get a numeric suffix, so each stays addressable."""
    seen: dict[str, int] = {}
    out = []
    for name in map(clean_name, names):
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


def first_existing(df: DataFrame, candidates: Iterable[str]) -> str:
    """The first candidate that is a column of ``df``; the order of candidates decides."""
    candidates = list(candidates)
    for name in candidates:
        if name in df.columns:
            return name
    raise KeyError(f"the table has no column named {' or '.join(candidates)}: {df.columns}")


def require_columns(df: DataFrame, required: Iterable[str], what: str) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"{what} lacks required columns: {missing}")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns of a numeric type, in table order. A declared double that is all NULL counts."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]


def feature_columns(df: DataFrame, keys: Iterable[str] = (), target: str = "pm25") -> list[str]:
    """Every column but the date, the target and the keys."""
    skip = {"date", target, *keys}
    return [c for c in df.columns if c not in skip]


def column_or(df: DataFrame, name: str, default):
    """The column if the table has it, else a literal. A NULL inside the column stays NULL."""
    return F.col(name) if name in df.columns else F.lit(default)
