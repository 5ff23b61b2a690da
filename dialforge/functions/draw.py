"""Seeded, partition-independent draws.

``rand(seed)`` depends on how rows are laid out in partitions, so a retried
task or a different partition count changes the sample. Every draw here is
instead a pure function of ``(seed, key columns, tag)``:

    u = first 15 hex digits of md5("seed|key1|...|tag")  ->  0 <= u < 2**60

which is uniform, stable across runs, and has an exact DuckDB twin (see
``u_sql``) so draws can be checked by an independent SQL engine. With 60 bits,
the modulo bias of ``u mod k`` is below ``k / 2**60`` -- negligible for any
pool size a cluster can hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60
_HEX = HASH_BITS // 4

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _tag(tag: str | Column) -> Column:
    return F.lit(tag) if isinstance(tag, str) else tag.cast("string")


def draw_key(seed: int, keys: Sequence[ColumnOrName] | ColumnOrName,
             tag: str | Column) -> Column:
    """The string hashed for a draw: ``seed|key...|tag``."""
    if isinstance(keys, (str, Column)):
        keys = [keys]
    parts = [F.lit(str(int(seed)))] + [_col(k).cast("string") for k in keys] + [_tag(tag)]
    return F.concat_ws("|", *parts)


def u(seed: int, keys: Sequence[ColumnOrName] | ColumnOrName,
      tag: str | Column) -> Column:
    """Uniform 60-bit non-negative ``long`` for ``(seed, keys, tag)``."""
    hexed = F.substring(F.md5(draw_key(seed, keys, tag)), 1, _HEX)
    return F.conv(hexed, 16, 10).cast("long")


def pick_index(seed: int, keys, tag, n: Column | int) -> Column:
    """0-based uniform index in ``[0, n)``."""
    n_col = F.lit(n) if isinstance(n, int) else n
    return F.pmod(u(seed, keys, tag), n_col.cast("long"))


def pick_from_array(seed: int, keys, tag, arr: Column) -> Column:
    """Uniform draw with replacement from a short array column (1-based
    ``element_at``); null for an empty array."""
    idx = pick_index(seed, keys, tag, F.size(arr))
    return F.when(F.size(arr) > 0, F.try_element_at(arr, (idx + 1).cast("int")))


def bucket_of(h: ColumnOrName, bits: int = 16) -> Column:
    """Top ``bits`` of a 60-bit draw: order-preserving bucket for ranking."""
    return F.shiftright(_col(h), HASH_BITS - bits).cast("int")


# ---------------------------------------------------------------- DuckDB twins

def u_sql(seed: int, keys: Sequence[str] | str, tag: str) -> str:
    """DuckDB expression equal to :func:`u`. ``keys`` are SQL expressions;
    ``tag`` is a SQL string expression (quote literals yourself)."""
    if isinstance(keys, str):
        keys = [keys]
    inner = ", ".join([str(int(seed))] + list(keys) + [tag])
    return (f"(('0x' || substr(md5(concat_ws('|', {inner})), 1, {_HEX}))"
            f"::UBIGINT)::BIGINT")


def pick_from_list_sql(seed: int, keys, tag: str, values: Sequence[str]) -> str:
    """DuckDB twin of :func:`pick_from_array` for a literal list."""
    lit = "[" + ", ".join(sql_str(v) for v in values) + "]"
    return f"({lit})[({u_sql(seed, keys, tag)} % {len(values)}) + 1]"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------- Python twin

def u_py(seed: int, keys, tag: str) -> int:
    """Python twin of :func:`u` (used inside pandas workers)."""
    import hashlib
    if not isinstance(keys, (list, tuple)):
        keys = [keys]
    s = "|".join([str(int(seed))] + [str(k) for k in keys] + [tag])
    return int(hashlib.md5(s.encode("utf-8")).hexdigest()[:_HEX], 16)
