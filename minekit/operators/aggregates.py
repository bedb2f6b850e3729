"""User aggregates that merge: a state is begun, updated by batches of rows, merged with others, and finished.

Tasks update one state per group and batch of rows; only states are shuffled. A group's states are merged in two steps,
so a group that holds most rows is worked on by all tasks and no task gets more than a share of its states.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: States that a task holds before it gives them away, and tasks' shares that are merged first.
HELD, SHARES = 10_000, 32


@dataclass(frozen=True)
class Aggregate:
    """`update` gets a state and a table of rows of one group, `merge` two states; `finish` gives a number or None.

    The order of rows and of merges is not defined, so both have to be right in any order.
    """

    zero: Callable[[], Any]
    update: Callable[[Any, pd.DataFrame], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], float | None]


def aggregate(df: DataFrame, aggregates: Mapping[str, Aggregate], columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, one double per aggregate) over the given columns; null keys are a group.

    Without `by` there is one row, of the begun states if the table is empty.
    """
    by, columns, named = list(by), list(columns), dict(aggregates)
    texts = [F.col(b).cast("string") for b in by]
    sized = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts]
    token = F.concat(*sized) if sized else F.lit("")
    marked = df.select(token.alias("_group"), *columns)

    def update(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict[str, dict[str, Any]] = {}

        def given() -> pd.DataFrame:
            out = pd.DataFrame({"_group": list(states), "_state": [pickle.dumps(s) for s in states.values()]})
            states.clear()
            return out

        for batch in batches:
            for group, part in batch.groupby("_group", sort=False):
                if group not in states:
                    states[group] = {n: a.zero() for n, a in named.items()}
                held = states[group]
                for n, a in named.items():
                    held[n] = a.update(held[n], part[columns])
            if len(states) > HELD:
                yield given()
        if states:
            yield given()

    def merged(states: Sequence[bytes]) -> dict[str, Any]:
        total = pickle.loads(states[0])
        for more in states[1:]:
            other = pickle.loads(more)
            total = {n: a.merge(total[n], other[n]) for n, a in named.items()}
        return total

    def join(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"_group": [key[0]], "_state": [pickle.dumps(merged(part["_state"].tolist()))]})

    def finish(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        state = merged(part["_state"].tolist())
        return pd.DataFrame({"_group": [key[0]]} | {n: pd.Series([a.finish(state[n])], dtype=float) for n, a in named.items()})

    ddl = "_group string, _state binary"
    values = ", ".join(f"`{n}` double" for n in named)
    states = marked.mapInPandas(update, ddl).withColumn("_share", F.spark_partition_id() % SHARES)
    halfway = states.groupBy("_group", "_share").applyInPandas(join, ddl)
    done = halfway.groupBy("_group").applyInPandas(finish, f"_group string, {values}")
    numbers = [F.when(~F.isnan(F.col(f"`{n}`")), F.col(f"`{n}`")).alias(n) for n in named]
    if by:
        groups = df.select(token.alias("_token"), *by).distinct()
        return groups.join(done, F.col("_token") == F.col("_group")).select(*by, *numbers)
    begun = df.sparkSession.createDataFrame([tuple(a.finish(a.zero()) for a in named.values())], values)
    return done.select(*numbers).unionByName(begun.where(F.lit(df.isEmpty())))
