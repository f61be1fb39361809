"""Decodes, status rules, defaults, patches, resets and flags.

Code tables are small fixed mappings; they become CASE expressions inside the
projection (no join, no shuffle).  Patch tables of any size go through
``apply_patch`` (a join, broadcast only for literal tables).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.fixed import DISQUALIFICATION, QUALIFICATION, RECORD


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_map(col, mapping: Mapping, default=None) -> Column:
    """``CASE col WHEN k THEN v ... ELSE default END``."""
    c = _c(col)
    out = None
    for k, v in mapping.items():
        cond = c == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out


def decode(col, mapping: Mapping, default=None, strict: bool = True) -> Column:
    """Exact decode (E1).  compat: null and unknown both take ``default``
    (quirk 9); strict: null stays null."""
    c = _c(col)
    mapped = case_map(c, mapping, default)
    return mapped if not strict else F.when(c.isNotNull(), mapped)


def decode_like(col, patterns: Sequence[tuple[str, str]]) -> Column:
    """First LIKE pattern that matches gives its label; none gives null."""
    c = _c(col)
    out = None
    for pat, label in patterns:
        cond = c.like(pat)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def status_override(source, otherwise, exact: Mapping[str, str],
                    patterns: Mapping[str, str] | None = None) -> Column:
    """Exact codes first, then regex hits, else keep ``otherwise``."""
    s = _c(source)
    out = None
    for k, v in exact.items():
        cond = s == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    for pat, v in (patterns or {}).items():
        cond = s.rlike(pat)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return _c(otherwise) if out is None else out.otherwise(_c(otherwise))


def fill_default(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """``coalesce(col, default)`` with the default cast to the column's type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c]))
                           for c, v in defaults.items()})


def apply_patch(df: DataFrame, patch: DataFrame, on: tuple[str, str],
                updates: Mapping[str, Column], small: bool = False) -> DataFrame:
    """Keyed value patch in one join (E5), not a loop of ``withColumn``.

    ``patch`` rows match ``df[on[0]] == patch[on[1]]``; each ``updates`` target
    takes its expression on matched rows and keeps its value elsewhere.  The
    expressions may use the patch's columns and the row's own (pre-patch) ones.
    ``small=True`` marks a literal patch table (a proven size bound) for
    broadcast; otherwise the planner decides from its size check (AQE).
    A patch key seen twice stops the job, so rows never fan out.
    """
    left_key, patch_key = on
    once = patch.filter(F.col(patch_key).isNotNull()).groupBy(F.col(patch_key).alias("__key")).agg(
        F.count(F.lit(1)).alias("__n"), F.min(F.struct(*patch.columns)).alias("__row"))
    hit = F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(
        F.concat(F.lit("patch key is not unique: "), F.col("__key").cast("string"))).cast("boolean"))
    p = once.select("__row.*", hit.alias("__hit"))
    p = F.broadcast(p) if small else p
    joined = df.join(p, df[left_key] == p[patch_key], "left")
    out = joined.withColumns({t: F.when(F.col("__hit"), e).otherwise(df[t])
                              for t, e in updates.items()})
    return out.select(*[out[t] if t in updates else df[t] for t in df.columns])


def reset_columns(df: DataFrame, key: str, keys: Iterable, values: Mapping[str, object]) -> DataFrame:
    """Set columns to fixed values for listed keys, all in one projection."""
    keys = list(keys)
    types = {f.name: f.dataType for f in df.schema.fields}
    hit = F.col(key).isin(keys)
    return df.withColumns({c: F.when(hit, F.lit(v).cast(types[c])).otherwise(F.col(c))
                           for c, v in values.items()})


def add_flags(df: DataFrame, code_col: str, codes: Mapping[str, str], flag: str,
              kind: str) -> DataFrame:
    """``flag`` = code is listed (false otherwise, null code too); ``kind`` = its label."""
    c = F.col(code_col)
    return df.withColumns({
        flag: F.coalesce(c.isin(list(codes)), F.lit(False)),
        kind: case_map(c, codes),
    })


def add_result_flags(df: DataFrame, result_col: str = "result",
                     info_col: str = "additional_info") -> DataFrame:
    """The gold fact's three flag pairs."""
    df = add_flags(df, result_col, QUALIFICATION, "qualified", "qualification_type")
    df = add_flags(df, result_col, DISQUALIFICATION, "disqualified", "disqualification_type")
    return add_flags(df, info_col, RECORD, "record", "record_type")
