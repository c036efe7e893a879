"""Replay of writes over a world and scoring of trajectories."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.functions.values import json_object

#: Calls of one episode, of any kind, that are replayed; the replay stops there (fixed value).
MOST_CALLS = 64
WRITES = ("wartung_einplanen", "crew_zuweisen", "wartung_status_setzen")


def last_valid_status(writes: DataFrame, key: list[str], status: str, order: str, terminal: str) -> DataFrame:
    """State of each key after its writes in order: a terminal state stops later ones.

    As an aggregate: the first terminal write if there is one, else the last write; no window over the key.
    """
    first_end = F.min(F.when(F.col(status) == terminal, F.col(order)))
    return writes.groupBy(*key).agg(
        F.coalesce(F.when(first_end.isNotNull(), F.lit(terminal)), F.max_by(status, order)).alias("state"), first_end.alias("ended_at"), F.count("*").alias("n_writes")
    )


def rejected_writes(writes: DataFrame, state: DataFrame, key: list[str], order: str) -> DataFrame:
    """Writes that came after the terminal one."""
    return writes.join(state.select(*key, "ended_at"), key).filter(F.col(order) > F.col("ended_at"))


def fold_writes(calls: list[dict], n_orders: int = 1000) -> tuple[int, int, str]:
    """(writes done, errors, digest of the state) after an episode's writes in order, over a world of ``n_orders`` orders.

    New orders get the ids after those, in the order of their making, so this is a fold and no set operation.
    """
    orders: dict[str, dict] = {}
    crew: set[tuple] = set()
    status: dict[str, str] = {}
    errors = done = 0
    for c in calls:
        tool, a = c["tool_name"], json_object(c["arguments"])
        if tool == "wartung_einplanen" and a.get("fahrzeug_id"):
            orders[f"WO-{n_orders + len(orders)}"] = {k: a[k] for k in sorted(a)}
            done += 1
        elif tool == "crew_zuweisen" and (key := tuple(str(a.get(k)) for k in ("zugnummer", "mitarbeiter_id", "rolle"))) not in crew and a.get("zugnummer"):
            crew.add(key)
            done += 1
        elif tool == "wartung_status_setzen" and a.get("auftrag_id") and status.get(str(a["auftrag_id"])) != "abgeschlossen":
            status[str(a["auftrag_id"])] = str(a.get("status"))
            done += 1
        else:
            errors += 1
    state = json.dumps([orders, sorted(crew), status], sort_keys=True, ensure_ascii=False)
    return done, errors, hashlib.sha256(state.encode()).hexdigest()[:16]


def replay(episodes: DataFrame, episode: str, calls: str, most_calls: int = MOST_CALLS, n_orders: int = 1000) -> DataFrame:
    """Ordered replay of all three kinds of writes of each episode over its own overlay of the world.

    ``calls`` holds the episode's calls in order as an array, so episodes are replayed where they lie, many in
    one batch, without a group of their own. Episodes without a write among the first ``most_calls`` calls are left out.
    """

    @F.pandas_udf("struct<n_done int, n_errors int, state string>")
    def run(arrays: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fold_writes(list(a), n_orders) for a in arrays], columns=["n_done", "n_errors", "state"])

    slim = F.transform(F.filter(F.slice(calls, 1, most_calls), lambda c: c["tool_name"].isin(*WRITES)), lambda c: F.struct(c["tool_name"].alias("tool_name"), c["arguments"].alias("arguments")))
    writes = episodes.select(episode, slim.alias("_w")).filter(F.size("_w") > 0)
    return writes.select(episode, run("_w").alias("_r")).select(episode, "_r.*")


def all_met(components: dict[str, Column]) -> Column:
    """1.0 where every component holds, else 0.0; a null component does not hold."""
    out = F.lit(True)
    for c in components.values():
        out = out & F.coalesce(c, F.lit(False))
    return F.when(out, 1.0).otherwise(0.0)


def components_of(components: dict[str, Column]) -> Column:
    return F.create_map(*(x for k, c in components.items() for x in (F.lit(k), F.coalesce(c, F.lit(False)))))

