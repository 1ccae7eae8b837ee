"""Joins of rows with a table of groups, where a few groups may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.llm.storage import settle

HOT_ROWS = 100
MOST_HOT = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str | list[str], total: int, count: str = "many") -> DataFrame:
    """`rows` joined with their groups on `key`, an inner join. groups: one row each, with its number of rows in `count`.

    A group is hot with HOT_ROWS rows and a MOST_HOT-th of all, so there are at most MOST_HOT of them: those are
    broadcast and their rows stay where they are. All others meet by a shuffle on the key.
    """
    key = [key] if isinstance(key, str) else key
    hot = settle(groups.where(F.col(count) >= max(HOT_ROWS, -(-total // MOST_HOT))))
    few = F.broadcast(hot)
    there = rows.join(few, key)
    rest = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(groups, key)
    return there.unionByName(rest.select(*there.columns)).drop(count)
