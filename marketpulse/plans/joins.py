"""Fact ⟕ dimension lookups that stay safe at any dimension size.

No size is guessed and nothing is hinted: Spark picks the join, and AQE turns a
shuffle join into a broadcast from the sizes it measures at run time. Hot
non-NULL keys are split by AQE's skew-join handling. Fact rows whose key is
NULL can never match; ``spread_by`` names the fact's id, whose hash then deals
them over all tasks. Only that one column is read for it, so a query that needs
three columns of a wide fact still scans, shuffles and sorts three.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__lookup_salt"


def _placeholder(type_name: str):
    """Any value of the key's type (the salt alone keeps NULL-key rows from matching)."""
    if type_name == "string":
        return ""
    if type_name in ("date", "timestamp", "timestamp_ntz"):
        return "1970-01-01"
    if type_name == "boolean":
        return False
    return 0


def _spread(fact: DataFrame, dim: DataFrame, fact_keys: list[str], dim_keys: list[str], spread_by: str):
    """Both sides with a second join key: 0 for every dimension row and every fact row with a
    full key, a hash of the id (never 0) for a fact row with a NULL in its key, whose key
    parts are set to a placeholder of their type."""
    any_null = F.lit(False)
    for k in fact_keys:
        any_null = any_null | F.col(k).isNull()
    h = F.xxhash64(spread_by)
    salt = F.when(any_null, F.when(h == 0, F.lit(1)).otherwise(h)).otherwise(F.lit(0)).cast("bigint")
    types = dict(fact.dtypes)
    parts = {f"__lk{i}": F.coalesce(F.col(k), F.lit(_placeholder(types[k])).cast(types[k])) for i, k in enumerate(fact_keys)}
    f2, d2 = fact.withColumns({_SALT: salt, **parts}), dim.withColumn(_SALT, F.lit(0).cast("bigint"))
    return f2, d2, [f2[f"__lk{i}"] == d2[d] for i, d in enumerate(dim_keys)] + [f2[_SALT] == d2[_SALT]], list(parts)


def lookup_join(fact: DataFrame, dim: DataFrame, fact_keys: Sequence[str] | str,
                dim_keys: Sequence[str] | str, drop_dim_keys: bool = True, spread_by: str | None = None) -> DataFrame:
    """``fact`` with the columns of the dimension row that has its key, or NULLs."""
    fact_keys = [fact_keys] if isinstance(fact_keys, str) else list(fact_keys)
    dim_keys = [dim_keys] if isinstance(dim_keys, str) else list(dim_keys)
    if spread_by is None:
        out = fact.join(dim, [fact[f] == dim[d] for f, d in zip(fact_keys, dim_keys)], "left")
    else:
        f2, d2, cond, parts = _spread(fact, dim, fact_keys, dim_keys, spread_by)
        out = f2.join(d2, cond, "left").drop(f2[_SALT]).drop(d2[_SALT]).drop(*parts)
    if drop_dim_keys:
        out = out.drop(*[d for d in dim_keys if d not in fact_keys])
    return out


def prefixed(dim: DataFrame, key: str, alias: str, *columns: str, **renamed: str) -> DataFrame:
    """A dimension cut down to its key, under another name, and the columns a lookup adds."""
    return dim.select(F.col(key).alias(alias), *columns, *[F.col(c).alias(n) for n, c in renamed.items()])


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` ⟕ ``right`` on group keys that may be NULL."""
    keys = list(keys)
    cond = [left[k].eqNullSafe(right[k]) for k in keys]
    return left.join(right, cond, "left").drop(*[right[k] for k in keys])
