"""Ordered change logs folded to the current row of each key.

A state keeps, for every column, the last value given and when it was given, and
for every key the time of its last deletion. Folding is a plain aggregate of
maxima: it combines before the shuffle, hot keys included, and two states merge to
the state of both logs together, in whichever order the changes arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import fixed_values as fixed
from shelfline.functions.columns import lookup, next_status
from shelfline.operators.pieces import ROWS_PER_PIECE
from shelfline.operators.series import with_previous
from shelfline.operators.snapshots import latest_per

CHANGED, DELETED = "_changed", "_deleted"


def last_change(changes: DataFrame, keys: Sequence[str],
                order: Sequence[str] = ("change_ts", "seq")) -> DataFrame:
    """The last change of each key, deletions included."""
    return latest_per(changes, keys, order)


def fold_changes(changes: DataFrame, keys: Sequence[str], columns: Sequence[str], *,
                 keep_earliest: Sequence[str] = (), op: str = "op",
                 order: Sequence[str] = ("change_ts", "seq")) -> DataFrame:
    """The state of a change log. A NULL gives no value, so it overwrites none.

    ``keep_earliest`` columns hold the smallest value any change of the key gave.
    """
    at = F.struct(*order)
    deletes = F.col(op) == fixed.OP_CODES["delete"]

    def given(name: str) -> Column:
        return F.when(F.col(name).isNotNull() & ~deletes, F.struct(at.alias("at"), F.col(name).alias("value")))

    return changes.groupBy(*keys).agg(
        F.max(at).alias(CHANGED),
        F.max(F.when(deletes, at)).alias(DELETED),
        *[F.max(given(name)).alias(name) for name in columns if name not in keep_earliest],
        *[F.min(name).alias(name) for name in keep_earliest])


def merge_states(one: DataFrame, other: DataFrame, keys: Sequence[str],
                 keep_earliest: Sequence[str] = ()) -> DataFrame:
    """The state of two logs together."""
    both = one.unionByName(other)
    return both.groupBy(*keys).agg(*[
        (F.min(name) if name in keep_earliest else F.max(name)).alias(name)
        for name in both.columns if name not in keys])


def current_rows(state: DataFrame, keys: Sequence[str], columns: Sequence[str], *,
                 keep_earliest: Sequence[str] = ()) -> DataFrame:
    """The rows a state holds. Keys last deleted are gone; values given before a deletion too."""
    deleted = F.col(DELETED)

    def after(at: Column) -> Column:
        return deleted.isNull() | (at > deleted)

    def value(name: str) -> Column:
        if name in keep_earliest:
            return F.col(name)
        return F.when(after(F.col(f"{name}.at")), F.col(f"{name}.value")).alias(name)

    return state.where(after(F.col(CHANGED))).select(*keys, *[value(name) for name in columns])


def apply_changes(state: DataFrame | None, changes: DataFrame, keys: Sequence[str],
                  columns: Sequence[str], *, keep_earliest: Sequence[str] = (), op: str = "op",
                  order: Sequence[str] = ("change_ts", "seq")) -> DataFrame:
    """The state after a further log. Applying a log twice changes nothing."""
    folded = fold_changes(changes, keys, columns, keep_earliest=keep_earliest, op=op, order=order)
    return folded if state is None else merge_states(state, folded, keys, keep_earliest)


def check_transitions(changes: DataFrame, keys: Sequence[str], *, status: str = "order_status",
                      order: Sequence[str] = ("change_ts", "seq"),
                      rows_per_piece: int | None = ROWS_PER_PIECE) -> DataFrame:
    """Add the status before, the one due next, and whether each step is INITIAL, LEGAL or ILLEGAL."""
    rows = with_previous(changes, keys, order, {"previous_status": status}, rows_per_piece=rows_per_piece)
    before, now = F.col("previous_status"), F.col(status)
    step = (F.when(before.isNull(), "INITIAL")
            .when(lookup(fixed.NEXT_STATUS, before) == now, "LEGAL")
            .otherwise("ILLEGAL"))
    return rows.withColumns({"next_status": next_status(now), "transition": step})
