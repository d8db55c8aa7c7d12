"""Feature inputs and guards shared by the operators.

A feature set is given either as a list of numeric column names, or as one
``array<double>`` column plus its width.  Both become a list of (name, Column)
pairs, so every operator compiles to plain column arithmetic inside
whole-stage codegen.  Guards are Column expressions (``raise_error``), so they
are checked on the executors while the data streams by, not by a driver scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_POLICIES = ("error", "drop")


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def named(df: DataFrame, name: str) -> Column:
    """A column by name; one that ``df`` does not have may be a path into a struct."""
    return quoted(name) if name in df.columns else F.col(name)


def refuse_names(df: DataFrame, new: Sequence[str]) -> None:
    """Output columns may not repeat the names of columns that are kept."""
    taken = sorted(set(new) & set(df.columns))
    if taken:
        raise ValueError(f"the result would have two columns named {', '.join(taken)}")


def width(df: DataFrame, col: str, dim: int | None = None) -> int:
    """The width of an array column: ``dim`` or, as in the reference, that of the first row."""
    if dim is None:
        first = df.select(F.size(named(df, col)).alias("d")).limit(1).collect()
        if not first:
            raise ValueError("cannot take the width of an empty dataset")
        dim = int(first[0]["d"])
    if dim <= 0:
        raise ValueError("vectors must have dimension larger than zero")
    return dim


def features(df: DataFrame, cols: Sequence[str] | str, dim: int | None = None
             ) -> list[tuple[str, Column]]:
    """Resolve ``cols`` to named double Columns.

    ``cols`` is a list of column names, or the name of an array column; the
    array width is ``dim`` or, as in the reference, probed from the first row.
    """
    if isinstance(cols, str):
        field = df.schema[cols]
        if field.dataType.typeName() != "array":
            return [(cols, quoted(cols).cast("double"))]
        dim = width(df, cols, dim)
        width_ok = F.size(quoted(cols)) == F.lit(dim)
        out = []
        for i in range(dim):
            value = quoted(cols)[i].cast("double")
            if i == 0:
                value = F.when(width_ok, value).otherwise(F.raise_error(F.lit(
                    f"dimensions mismatch: expecting {dim} values in {cols}")))
            out.append((f"{cols}[{i}]", value))
        return out
    cols = list(cols)
    if not cols:
        raise ValueError("at least one feature column is required")
    return [(c, named(df, c).cast("double")) for c in cols]


def apply_null_policy(df: DataFrame, cols: Sequence[str], nulls: str) -> DataFrame:
    """``'drop'`` removes rows with a null in any of ``cols`` (listwise);
    ``'error'`` leaves rows alone — operators then fail on a null they meet."""
    if nulls not in NULL_POLICIES:
        raise ValueError(f"nulls must be one of {NULL_POLICIES}, got {nulls!r}")
    if nulls == "drop":
        for c in cols:
            x = named(df, c)
            kind = df.select(x.alias("x")).schema["x"].dataType.typeName()
            df = df.filter(x.isNotNull() & ~F.isnan(x) if kind in ("double", "float") else x.isNotNull())
    return df


def not_null(value: Column, what: str) -> Column:
    """``value`` unchanged, or a task failure when it is null."""
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.lit(f"null value in {what}; pass nulls='drop' to skip such rows")))


def check(cond: Column, value: Column, message: str) -> Column:
    """``value`` when ``cond`` holds, else a task failure with ``message``."""
    return F.when(cond, value).otherwise(F.raise_error(F.lit(message)))


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
              how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` treating null keys as equal (a null group is a
    group).  Spark plans ``<=>`` keys as an ordinary hash / sort-merge join."""
    keys = list(keys)
    tmp = [f"_jk{i}" for i in range(len(keys))]
    r = right.select(*[quoted(k).alias(t) for k, t in zip(keys, tmp)],
                     *[quoted(c) for c in right.columns if c not in keys])
    cond = None
    for k, t in zip(keys, tmp):
        c = quoted(k).eqNullSafe(F.col(t))
        cond = c if cond is None else cond & c
    return left.join(r, on=cond, how=how).drop(*tmp)
