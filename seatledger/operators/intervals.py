"""Equality join bounded in time, safe for hot keys."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SLOT, _LANE, _HOT = "__slot", "__lane", "__hot"
SHORTEST_SLOT = 3600


class Lanes(NamedTuple):
    """From slots that begin at ``since`` on (in seconds, null: always), how many lanes the rows of ``key`` are dealt to."""

    key: str
    since: int | None
    left: int
    right: int


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_time: str,
    right_time: str,
    *,
    lower: int = 0,
    upper: int = 600,
    extra: Column | None = None,
    spread: int = 1,
    spread_by: list[str] | None = None,
    slots: bool = True,
    lanes: list[Lanes] | None = None,
    lanes_by: list[str] | None = None,
) -> DataFrame:
    """Inner join on ``on`` where ``right_time - left_time`` is in ``lower..upper`` seconds.

    The key alone would bring all rows of a hot key into one task and compare
    every pair of them.  So time is cut into slots several times wider than the
    interval and the slot becomes a part of the join key: a left row has one
    slot, a right row is repeated for the (one, seldom two) slots its partners
    can lie in.  Pairs far apart in time are never compared, and a hot key is
    spread over its slots.  Every partner lies in exactly one slot, so no pair
    is lost or doubled.  Many left rows within one slot are split at run time by
    adaptive skew handling; on streams, where that is off, ``spread`` deals the
    left rows of a slot to that many lanes by a hash of ``spread_by`` and
    repeats the right rows for each lane.

    The time bounds are part of the join condition, so on watermarked streams
    they also limit the state.  Other columns must not share names.  Without
    ``slots`` the key alone decides where rows meet, for tables stored by it.

    ``lanes`` names the hot keys and their lanes instead of giving all keys as
    many: a side's rows of such a key are dealt to its lanes by a hash, the other
    side's are repeated for each of them.  Which lanes count is told by the key and
    the slot, so both sides agree whenever their rows come.  Right rows are dealt
    by their time and the columns ``lanes_by``.  An empty list gives every key one
    lane and, on streams, the state a form that later lists can go on with.
    """
    shared = (set(left.columns) & set(right.columns)) - {on}
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    if upper < lower:
        raise ValueError("upper must not be below lower")
    if lanes is not None and (spread > 1 or not slots):
        raise ValueError("lanes need slots and take the place of spread")
    right_on, right_slot, right_lane = f"__right_{on}", f"{_SLOT}_right", f"{_LANE}_right"
    right = right.withColumnRenamed(on, right_on).filter(F.col(right_time).isNotNull())
    where = F.col(on) == F.col(right_on)
    if slots:
        width = max(SHORTEST_SLOT, 6 * (upper - lower))
        left = left.withColumn(_SLOT, _slot(F.unix_seconds(left_time), width))
        moment = F.unix_seconds(right_time)
        reached = F.sequence(_slot(moment - upper, width), _slot(moment - lower, width))
        right = right.select("*", F.explode(reached).alias(right_slot))
        where = where & (F.col(_SLOT) == F.col(right_slot))
    if lanes is not None:
        left = _dealt(left, on, _SLOT, width, lanes, spread_by or [left_time], left_side=True)
        right = _dealt(right, right_on, right_slot, width, lanes, [right_time, *(lanes_by or [])], left_side=False)
        right = right.withColumnRenamed(_LANE, right_lane)
        where = where & (F.col(_LANE) == F.col(right_lane))
    if spread > 1:
        by = [F.col(c) for c in (spread_by or [left_time])]
        left = left.withColumn(_LANE, F.pmod(F.xxhash64(*by), F.lit(spread)).cast("int"))
        lanes = F.sequence(F.lit(0), F.lit(spread - 1))
        right = right.select("*", F.explode(lanes).alias(right_lane))
        where = where & (F.col(_LANE) == F.col(right_lane))
    where = (
        where
        & (F.col(right_time) >= F.col(left_time) + _seconds(lower))
        & (F.col(right_time) <= F.col(left_time) + _seconds(upper))
    )
    if extra is not None:
        where = where & extra
    joined = left.join(right, where, "inner")
    return joined.drop(_SLOT, right_slot, right_on, _LANE, right_lane)


def _dealt(rows: DataFrame, key: str, slot: str, width: int, lanes: list[Lanes], by: list[str], left_side: bool) -> DataFrame:
    """Rows with their lanes: lane ``i * right + j`` is met by left rows of draw ``i`` and right rows of draw ``j``."""
    entries: dict[str, list[Lanes]] = {}
    for entry in lanes:
        entries.setdefault(entry.key, []).append(entry)
    begin = F.col(slot) * F.lit(width)
    one = F.struct(F.lit(1).alias("left"), F.lit(1).alias("right"))
    held = F.lit(None)
    for name, of_key in entries.items():
        choice = one
        for e in sorted(of_key, key=lambda e: -(2**62) if e.since is None else e.since):
            pair = F.struct(F.lit(e.left).alias("left"), F.lit(e.right).alias("right"))
            choice = pair if e.since is None else F.when(begin >= F.lit(e.since), pair).otherwise(choice)
        held = F.when(F.col(key).cast("string") == F.lit(name), choice).otherwise(held)
    rows = rows.withColumn(_HOT, F.coalesce(held, one))
    left, right = F.col(f"{_HOT}.left"), F.col(f"{_HOT}.right")
    draw = F.pmod(F.xxhash64(*by), left if left_side else right).cast("int")
    if left_side:
        reached = F.transform(F.sequence(F.lit(0), right - 1), lambda j: draw * right + j)
    else:
        reached = F.transform(F.sequence(F.lit(0), left - 1), lambda i: i * right + draw)
    return rows.select("*", F.explode(reached).alias(_LANE)).drop(_HOT)


def _slot(seconds: Column, width: int) -> Column:
    return F.floor(seconds / F.lit(width)).cast("long")


def _seconds(n: int) -> Column:
    return F.expr(f"INTERVAL '{int(n)}' SECOND")
