"""Silver and gold kept up to date batch by batch, at the cost of what is new.

Additive tables (calls, cube, users of a day) are stored as parts, one per
source and batch of its stream; a batch that is run again replaces its part,
so nothing counts twice. The daily tables are made anew for the dates that a
batch touches and, for their rolling means, for the six rows after.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import date
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from callmeter.functions.columns import stamped
from callmeter.operators.durable import cut_lineage
from callmeter.operators.together import run_together
from callmeter.operators.windows import last_rows
from callmeter.plans import gold, silver
from callmeter.sources.lake import Lake, on_dates

_KEPT = "SELECT * EXCEPT (refused, failed_rules, source, batch) FROM {parts} WHERE NOT refused"
_REFUSED = "SELECT * EXCEPT (refused, source, batch) FROM {parts} WHERE refused"
_SUMS = ", ".join(f"sum({name}) AS {name}" for name in gold.MEASURES)
_KEYS = ", ".join(gold.CUBE_KEYS)
_CUBE = f"SELECT {_KEYS}, {_SUMS} FROM {{parts}} GROUP BY {_KEYS}"
_USERS = "SELECT event_date, model, count(DISTINCT user_id) AS unique_users FROM {parts} GROUP BY event_date, model"
_USER_DAYS = "SELECT DISTINCT event_date, model, user_id FROM {parts}"
_SKETCHES = "SELECT event_date, team, model, hll_union_agg(user_sketch) AS user_sketch FROM {parts} GROUP BY event_date, team, model"
# Tables of parts: the query that shows one, and the query that merges several parts into one.
ADDITIVE = {
    "call_cube": (_CUBE, _CUBE),
    "daily_users": (_USERS, _USER_DAYS),
    "user_sketches": (_SKETCHES, _SKETCHES),
}
# The part that older batches' partial rows are merged into.
MERGED = "merged"
_MERGED = "callmeter.merged"


def _series_around(
    stored: DataFrame | None, fresh: DataFrame, key: str, day: str, dates: Sequence[date | None], roll: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The rows of a daily table on dates whose rolling mean the dates reach, with new rolling means; stored.

    ``fresh`` are the table's rows on ``dates``. A row that is gone changes the
    means of the rows after it as well, so both the old and the new series are
    looked at.
    """
    if stored is None:
        return roll(fresh)
    old = stored.select(*fresh.columns)
    series = old.filter(~on_dates(day, dates)).unionByName(fresh)
    frame = last_rows(key, day, gold.ROLLING)
    near = F.max(on_dates(day, dates)).over(frame).alias("_near")
    before = old.select(F.col(day).alias("_day"), near).filter("_near")
    after = series.select(F.col(day).alias("_day"), near).filter("_near")
    reached = before.unionByName(after).select("_day").distinct()
    rolled = roll(series)
    return cut_lineage(rolled.join(F.broadcast(reached), rolled[day].eqNullSafe(F.col("_day"))).drop("_day"))


def _replace_series(
    lake: Lake, table: str, fresh: DataFrame, key: str, day: str, dates: Sequence[date | None], roll: Callable[[DataFrame], DataFrame]
) -> None:
    rows = _series_around(lake.load_if_exists("gold", table), fresh, key, day, dates, roll)
    reached = {r[0] for r in rows.select(day).distinct().collect()}
    rows = stamped(rows, "gold_loaded_at", F.current_timestamp())
    lake.replace_dates(rows, "gold", table, day, [*reached.union(dates)])


def refresh_cost_tables(lake: Lake, dates: Sequence[date | None]) -> None:
    """Bring the daily tables of calls up to date on ``dates``, from the stored cube and users.

    No call is read, and only the rows on ``dates`` are written, besides the
    rows of daily costs whose rolling mean they reach.
    """
    now = F.current_timestamp()
    touched = on_dates("event_date", dates)
    cube = cut_lineage(lake.load("gold", "call_cube").filter(touched))
    users = lake.load("gold", "daily_users").filter(touched)
    costs, breakdown = gold.cost_per_day(cube), gold.feature_cost_breakdown(cube, now)
    performance = gold.model_performance_summary(None, now, cube=cube, users=users)
    run_together(
        lambda: _replace_series(lake, "daily_cost_by_team", costs, "team", "event_date", dates, gold.rolling_cost),
        lambda: lake.replace_dates(breakdown, "gold", "feature_cost_breakdown", "event_date", dates),
        lambda: lake.replace_dates(performance, "gold", "model_performance_summary", "event_date", dates),
    )


def refresh_quality(lake: Lake, feedback: DataFrame, dates: Sequence[date | None]) -> None:
    """Bring the daily scores up to date on ``dates``, from the feedback of these dates."""
    if dates:
        fresh = gold.quality_per_day(feedback.filter(on_dates("feedback_date", dates)))
        _replace_series(lake, "quality_score_daily", fresh, "model", "feedback_date", dates, gold.rolling_quality)


def _dates(df: DataFrame, day: str = "event_date") -> set[date | None]:
    return {r[0] for r in df.select(day).distinct().collect()}


def keep_calls(lake: Lake, source: str) -> Callable[[DataFrame, int], None]:
    """A writer for ``foreachBatch`` that takes a batch of bronze calls through silver and gold.

    The calls are read once, from the batch; the rest is read from what the
    batch has stored. Refused calls are stored beside the others, with the
    rules they fail. A batch that is repeated after a failure replaces its own
    parts and ends with the same tables; a batch older than the source's last
    one is a repeat of something complete and is left alone.
    """

    def keep(calls: DataFrame, batch: int) -> None:
        own = Lake(calls.sparkSession, lake.prefix, lake.format)
        last = own.last_batch("silver", "api_calls", source)
        if last is not None and batch < last:
            return
        held = _dates(own.parts("gold", "call_cube", source, batch)) if last == batch else set()
        rows = silver.marked_calls(calls, own.load("bronze", "model_pricing"), loaded_at=F.current_timestamp())
        own.write_part(rows, "silver", "api_calls", source, batch, _KEPT, split_by=("refused",))
        if not own.exists("silver", "api_calls_refused"):
            own.define("silver", "api_calls_refused", _REFUSED.format(parts=f"{own.name('silver', 'api_calls')}__parts"))
        kept = own.parts("silver", "api_calls", source, batch).filter("NOT refused")
        rows = {"call_cube": gold.call_cube(kept), "daily_users": gold.user_days(kept), "user_sketches": gold.user_sketches(kept)}
        run_together(
            *(
                partial(own.write_part, rows[table], "gold", table, source, batch, view)
                for table, (view, _) in ADDITIVE.items()
            )
        )
        dates = held | _dates(own.parts("gold", "call_cube", source, batch))
        if dates:
            refresh_cost_tables(own, list(dates))

    return keep


def keep_up(lake: Lake, calls: DataFrame, source: str, checkpoint_root: str) -> StreamingQuery:
    """Take what a stream of bronze calls has received since the last run through silver and gold, then stop.

    A lake is kept by this or by ``refresh_silver`` and ``refresh_gold``, which
    write whole tables.
    """
    writer = calls.writeStream.foreachBatch(keep_calls(lake, source))
    return writer.option("checkpointLocation", f"{checkpoint_root}/upkeep_{source}").trigger(availableNow=True).start()


def rule_counts(lake: Lake, source: str | None = None, batch: int | None = None) -> dict[str, int]:
    """Records and failures by rule of all calls, or of those of a source or batch, from what is stored."""
    return silver.marked_counts(lake.parts("silver", "api_calls", source, batch))


def merge_parts(lake: Lake) -> None:
    """Merge the additive parts of all but each source's last batch into one.

    The last batch of a source may be run again and keeps a part of its own.
    A table's view is switched to the merged part in one step once that is
    complete, and the parts it stands for are dropped after, so a failure at
    any point neither loses nor doubles a row.
    """
    for table, (view, merge) in ADDITIVE.items():
        parts = f"{lake.name('gold', table)}__parts"
        merged, since = _merged(lake, table)
        live = _live(merged, since)
        stored = lake.parts("gold", table).filter(live).filter(F.col("source") != MERGED)
        last = {r["source"]: r["batch"] for r in stored.groupBy("source").agg(F.max("batch").alias("batch")).collect()}
        recent = " OR ".join(f"(source = '{s}' AND batch >= {b})" for s, b in last.items()) or "false"
        rows = cut_lineage(lake.spark.sql(merge.format(parts=f"{parts} WHERE ({live}) AND NOT ({recent})")))
        lake.write_part(rows, "gold", table, MERGED, merged + 1, view)
        told = json.dumps({"merged": merged + 1, "since": last})
        lake.define("gold", table, view.format(parts=f"{parts} WHERE {_live(merged + 1, last)}"), {_MERGED: told})
        gone = lake.parts("gold", table).filter(f"NOT ({_live(merged + 1, last)})").select("source", "batch").distinct()
        for r in gone.collect():
            lake.spark.sql(f"ALTER TABLE {parts} DROP IF EXISTS PARTITION (source = '{r['source']}', batch = {r['batch']})")


def _merged(lake: Lake, table: str) -> tuple[int, dict[str, int]]:
    """The number of a table's merged part, and the first batch of each source that is not in it."""
    told = json.loads(lake.properties("gold", table).get(_MERGED, "{}"))
    return told.get("merged", -1), told.get("since", {})


def _live(merged: int, since: dict[str, int]) -> str:
    """SQL for the parts that count."""
    before = "".join(f" AND NOT (source = '{s}' AND batch < {b})" for s, b in since.items())
    return f"(source = '{MERGED}' AND batch = {merged}) OR (source <> '{MERGED}'{before})"
