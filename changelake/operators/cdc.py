"""Change-log reconciliation: newest row per key, deletes dropped.

The newest version of a key is chosen by ``row_number()`` over the key ordered
by capture time (newest first, NULL times last). Catalyst turns the
``row_number() = 1`` filter into a ``WindowGroupLimit``: a partial top-1 runs on
the map side before the shuffle, so a hot key with millions of versions sends
at most one row per input split across the network.

The delete filter is applied *after* choosing the newest row -- pushing it below
the window would resurrect the previous version of a deleted key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import parse_capture_ts
from ..schemas import CAPTURE_TS_COL, OP_COL, OP_DELETE, OP_INSERT, OP_UPDATE

ROW_NUM_COL = "_row_num"
_NULL_KEY_ROW = "_null_key_row"

# Tie rank of operations at equal capture time (higher wins):
# a delete beats an update beats an insert; unknown or NULL codes rank lowest.
OP_TIE_RANK = {OP_DELETE: 3, OP_UPDATE: 2, OP_INSERT: 1}


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def op_rank(op_col: str = OP_COL) -> Column:
    rank = F.lit(0)
    for code, value in sorted(OP_TIE_RANK.items(), key=lambda kv: kv[1]):
        rank = F.when(F.col(op_col) == code, F.lit(value)).otherwise(rank)
    return rank


def recency_order(ts_col: str = CAPTURE_TS_COL, op_col: str | None = OP_COL,
                  tie_breakers: Sequence[Column | str] = (),
                  order_as: str = "string") -> list[Column]:
    """Sort expressions, newest first: capture time desc (NULL last), then the
    operation rank (a delete at the same instant beats an update beats an
    insert), then the caller's tie breakers (descending when given as names)."""
    if order_as == "string":
        ts = F.col(ts_col)
    elif order_as == "timestamp":
        ts = parse_capture_ts(ts_col)
    else:
        raise ValueError("order_as must be 'string' or 'timestamp'")
    order = [ts.desc_nulls_last()]
    if op_col is not None:
        order.append(op_rank(op_col).desc())
    for tb in tie_breakers:
        order.append(F.col(tb).desc_nulls_last() if isinstance(tb, str) else tb)
    return order


def whole_row(columns: Sequence[str], known: Sequence[str]) -> list[Column]:
    """The last tie breakers: every column that is not ``known`` to tie, in order
    and descending, so that rows which tie on everything else still have one
    defined winner. Plain columns, not a struct of them: a struct would be
    computed below the exchange and every row would be shuffled twice over."""
    return [F.col(c).desc_nulls_last() for c in columns if c not in set(known)]


def latest_per_key(df: DataFrame, keys: str | Sequence[str], *,
                   ts_col: str = CAPTURE_TS_COL, op_col: str | None = OP_COL,
                   tie_breakers: Sequence[Column | str] = (),
                   order_as: str = "string") -> DataFrame:
    """Newest row per key, capture columns kept (deletes included)."""
    keys = _as_list(keys)
    return _newest(df, keys, keys, ts_col, op_col, tie_breakers, order_as)


def _newest(df: DataFrame, part: Sequence[str], keys: Sequence[str], ts_col, op_col, tie_breakers,
            order_as) -> DataFrame:
    order = recency_order(ts_col, op_col, tie_breakers, order_as)
    last = whole_row(df.columns, [*keys, *(t for t in tie_breakers if isinstance(t, str)), _NULL_KEY_ROW])
    w = Window.partitionBy(*part).orderBy(*order, *last)
    return (df.withColumn(ROW_NUM_COL, F.row_number().over(w))
              .filter(F.col(ROW_NUM_COL) == 1)
              .drop(ROW_NUM_COL))


def drop_deleted(df: DataFrame, op_col: str = OP_COL) -> DataFrame:
    """Keep rows whose newest operation is not a delete. A NULL operation is
    not known to be live, so it is dropped as well (three-valued ``!=``)."""
    return df.filter(F.col(op_col) != OP_DELETE)


def reconcile(df: DataFrame, keys: str | Sequence[str], *,
              ts_col: str = CAPTURE_TS_COL, op_col: str = OP_COL,
              tie_breakers: Sequence[Column | str] = (),
              order_as: str = "string", null_keys: str = "group",
              keep_capture_cols: bool = False) -> DataFrame:
    """Current state of a change log: one live row per key.

    ``null_keys='group'`` treats all rows whose key is NULL as one key (plain
    window semantics, at most one survives). ``null_keys='keep'`` passes every
    such row through un-collapsed so key rules downstream can quarantine
    each of them.
    """
    keys = _as_list(keys)
    if null_keys not in ("group", "keep"):
        raise ValueError("null_keys must be 'group' or 'keep'")
    if null_keys == "keep":
        has_null = F.lit(False)
        for k in keys:
            has_null = has_null | F.col(k).isNull()
        # One pass: a row without a key is a group of its own.
        numbered = df.withColumn(_NULL_KEY_ROW, F.when(has_null, F.monotonically_increasing_id()))
        current = _newest(numbered, [*keys, _NULL_KEY_ROW], keys, ts_col, op_col, tie_breakers,
                          order_as).drop(_NULL_KEY_ROW)
    else:
        current = latest_per_key(df, keys, ts_col=ts_col, op_col=op_col,
                                 tie_breakers=tie_breakers, order_as=order_as)
    current = drop_deleted(current, op_col)
    return current if keep_capture_cols else current.drop(op_col, ts_col)
