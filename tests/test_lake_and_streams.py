"""Bronze streams into a lake, and the stored layers built from them."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from callmeter import fixtures
from callmeter.plans import gold, refresh, silver
from callmeter.schemas import CALL_SCHEMA, FEEDBACK_SCHEMA, TABLES
from callmeter.sources import readers
from callmeter.sources.lake import Lake, on_dates
from callmeter.sources.csv_files import read_csv
from callmeter.streaming.bronze import _store_csv, run_bronze, surplus_values

from builders import CALL


def write_json(folder, name, *calls):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({**CALL, **c}) if isinstance(c, dict) else c for c in calls))


def test_streams_read_only_new_files(spark, tmp_path):
    lake = Lake(spark, "streams_")
    lake.create()
    logs, prices, votes, topic = (tmp_path / n for n in ("logs", "prices", "votes", "topic"))
    for folder in (prices, votes):
        folder.mkdir()
    (prices / "p.csv").write_text(
        "model,prompt_price_per_1k_tokens,completion_price_per_1k_tokens,provider\ngpt-4o,0.0050,0.00015,p1\n"
    )
    (votes / "f.csv").write_text("date,model,thumbs_up\n2026-01-01,gpt-4o,1\n2026-01-01,gpt-4o,0\n")
    write_json(logs, "a.json", {"call_id": "a1"}, {"call_id": "a2"}, "{broken")

    def messages(*values):
        rows = [(bytearray(v.encode()), None) for v in values]
        spark.createDataFrame(rows, "value binary, timestamp timestamp").write.mode("append").parquet(str(topic))

    messages(json.dumps({**CALL, "call_id": "k1"}), "garbage")

    def run():
        # The topic is stood in for by a stream of files with the same two columns.
        source = spark.readStream.schema("value binary, timestamp timestamp").parquet(str(topic))
        ended = run_bronze(
            lake,
            {
                "api_calls_historical": readers.calls_json(spark, str(logs), maxFilesPerTrigger=1),
                "model_pricing": readers.pricing_csv(spark, str(prices)),
                "quality_feedback": readers.feedback_csv(spark, str(votes)),
                "api_calls_live": readers.calls_kafka(source),
            },
            str(tmp_path / "progress"),
        )
        return {table: sum(p["numInputRows"] for p in query.recentProgress) for table, query in ended.items()}

    first = run()
    # Input rows of CSV streams are files.
    assert first == {"api_calls_historical": 3, "model_pricing": 1, "quality_feedback": 1, "api_calls_live": 2}
    assert lake.load("bronze", "quality_feedback").count() == 2
    write_json(logs, "b.json", {"call_id": "b1"})
    messages(json.dumps({**CALL, "call_id": "k2"}))
    second = run()
    assert second == {"api_calls_historical": 1, "model_pricing": 0, "quality_feedback": 0, "api_calls_live": 1}

    history, live = lake.load("bronze", "api_calls_historical"), lake.load("bronze", "api_calls_live")
    assert {r.call_id for r in history.collect()} == {"a1", "a2", "b1", None}
    assert {r.call_id for r in live.collect()} == {"k1", "k2", None}
    batch = spark.read.schema(CALL_SCHEMA).json(str(logs))
    names = CALL_SCHEMA.fieldNames()
    assert history.select(names).exceptAll(batch).isEmpty() and batch.exceptAll(history.select(names)).isEmpty()
    assert history.filter("ingested_at is null").isEmpty()

    counted = refresh.refresh_silver(lake, by_day=True)
    assert counted["api_calls"]["records"] == 7 and counted["api_calls"]["valid_call_id"] == 2
    stored = lake.load("silver", "api_calls")
    pruned = stored.filter("event_date = date'2025-11-08'").select("cost_usd")
    # The day is a filter on folders, beside that on refused calls.
    assert {"event_date=2025-11-08" in f and "refused=false" in f for f in pruned.inputFiles()} == {True}
    assert sorted(r.call_id for r in stored.collect()) == ["a1", "a2", "b1", "k1", "k2"]
    assert {"kafka_timestamp", "silver_loaded_at", "cost_usd"} <= set(stored.columns)
    assert not {"timestamp", "ingested_at", "provider"} & set(stored.columns)


def test_csv_is_read_by_its_header(spark, tmp_path):
    """Columns in any order and number; files that lack a column are refused and listed."""
    votes = tmp_path / "votes"
    votes.mkdir()
    (votes / "a.csv").write_text("date,model,thumbs_up\n2026-01-01,gpt-4o,1\n")
    (votes / "b.csv").write_bytes(
        b'\xef\xbb\xbfid,thumbs_up,comment, model ,date\r\n7,0,"so, so",gpt-4o,2026-01-02\r\n8,,"",m\r\n\r\n'
    )
    (votes / "c.csv").write_text("date,model\n2026-01-03,gpt-4o\n")
    (votes / "d.csv").write_text("\n")
    (votes / "e.csv").write_text("thumbs_up,date,model\n")
    many = ",".join(f"x{i}" for i in range(80))
    (votes / "f.csv").write_text(f"{many},date,model,thumbs_up\n{many},2026-01-04,gpt-4o,1\n")
    (votes / "g.csv").write_text('date,comment,model,thumbs_up\n2026-01-05,"two\nlines, 1,1",gpt-4o,1\n2026-01-06,"",gpt-4o,0\n')
    (votes / "h.csv").write_text("date,model,thumbs_up\n2026-01-07,gpt-4o,1,5,6\n2026-01-08,gpt-4o,0\n")
    (votes / "i.csv").write_text("date,model,thumbs_up,model\n2026-01-09,gpt-4o,1,x\n")
    lake = Lake(spark, "by_header_")
    lake.create()
    for _ in range(2):
        run_bronze(lake, {"quality_feedback": readers.feedback_csv(spark, str(votes))}, str(tmp_path / "progress"))
    stored = lake.load("bronze", "quality_feedback")
    assert stored.columns == ["date", "model", "thumbs_up", "ingested_at"]
    assert sorted((r["date"], r["model"], r["thumbs_up"]) for r in stored.filter("date is not null").collect()) == [
        ("2026-01-01", "gpt-4o", "1"),
        ("2026-01-02", "gpt-4o", "0"),
        ("2026-01-04", "gpt-4o", "1"),
        ("2026-01-05", "gpt-4o", "1"),
        ("2026-01-06", "gpt-4o", "0"),
        ("2026-01-07", "gpt-4o", "1"),
        ("2026-01-08", "gpt-4o", "0"),
    ]
    assert stored.filter("date is null").select("model", "thumbs_up").collect() == [("m", None)]
    refused = lake.load("bronze", "refused_files").collect()
    assert sorted((r["path"][-5:], r["missing"]) for r in refused) == [
        ("c.csv", ["thumbs_up"]),
        ("d.csv", ["date", "model", "thumbs_up"]),
        ("i.csv", ["model"]),
    ]
    assert {r["table_name"] for r in refused} == {"quality_feedback"}
    surplus = [(r["source_file"][-5:], r["surplus_record"]) for r in surplus_values(lake, "quality_feedback").collect()]
    assert surplus == [("h.csv", "2026-01-07,gpt-4o,1,5,6")]
    # A batch that is stored again replaces its part.
    before = sorted(map(tuple, stored.drop("ingested_at").collect()), key=repr)
    store = _store_csv(lake, FEEDBACK_SCHEMA, "quality_feedback")
    files = spark.createDataFrame([(f"file:{p}", 0) for p in sorted(votes.iterdir())], "path string, length long")
    store(files, 0)
    again = lake.load("bronze", "quality_feedback").drop("ingested_at").collect()
    assert sorted(map(tuple, again), key=repr) == before


def test_a_large_csv_file_is_split(spark, tmp_path):
    (tmp_path / "big.csv").write_text("date,model,thumbs_up\n" + "2026-01-01,gpt-4o,1\n" * 60_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        rows, refused = read_csv(spark, [str(tmp_path / "big.csv")], FEEDBACK_SCHEMA)
        assert rows.rdd.getNumPartitions() > 4 and rows.count() == 60_000 and refused.isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_failed_write_leaves_the_old_table(spark):
    lake = Lake(spark, "swap_")
    lake.create()
    good = spark.range(5).withColumn("team", F.lit("ops"))
    lake.materialize(good, "gold", "cost_predictions")
    bad = lake.load("gold", "cost_predictions").withColumn("team", F.raise_error(F.lit("broken off")).cast("string"))
    with pytest.raises(Exception, match="broken off"):
        lake.materialize(bad, "gold", "cost_predictions")
    assert lake.load("gold", "cost_predictions").count() == 5
    # A table may be replaced by rows of its own.
    lake.materialize(lake.load("gold", "cost_predictions").filter("id < 2"), "gold", "cost_predictions")
    assert lake.load("gold", "cost_predictions").count() == 2
    assert [tuple(r) for r in lake.layer_tables().collect()] == [("gold", "cost_predictions")]
    assert len(spark.catalog.listTables("swap_gold")) <= 3


def test_refresh_of_touched_dates_equals_a_full_one(spark, sf_dir):
    lake = Lake(spark, "dates_")
    lake.create()
    early, late = (F.lit(t).cast("timestamp") for t in ("2026-01-01", "2026-01-02"))
    calls = fixtures.calls_dirty(spark, sf_dir).filter("timestamp LIKE '1995-0%' OR timestamp LIKE 'not%'")
    days = [r[0] for r in calls.filter("timestamp LIKE '1995%'").select("timestamp").distinct().orderBy("timestamp").take(9)]
    second = F.col("timestamp").isin(days[3], days[8], "not-a-time")
    lake.materialize(fixtures.prices(spark), "bronze", "model_pricing")
    lake.materialize(fixtures.feedback(spark, sf_dir), "bronze", "quality_feedback")
    lake.materialize(calls.filter(~second).withColumn("ingested_at", early), "bronze", "api_calls_historical")
    refresh.refresh_silver(lake, by_day=True)
    refresh.refresh_gold(lake)
    both = calls.withColumn("ingested_at", F.when(second, late).otherwise(early))
    lake.materialize(both, "bronze", "api_calls_historical")
    refresh.refresh_silver(lake, by_day=True)
    dates = refresh.touched_dates(lake, late)
    assert {str(d) for d in dates} == {days[3][:10], days[8][:10], "None"}
    votes = [r[0] for r in lake.load("silver", "quality_feedback").select("feedback_date").distinct().orderBy("feedback_date").take(3)]
    refresh.refresh_gold(lake, dates, feedback_dates=votes[1:2])
    names = ("quality_score_daily", "call_cube", "daily_users", "daily_cost_by_team", "feature_cost_breakdown", "model_performance_summary")
    found = {name: lake.load("gold", name).drop("gold_loaded_at").toPandas() for name in names}
    refresh.refresh_gold(lake)
    for name in names:
        whole = lake.load("gold", name).drop("gold_loaded_at").toPandas()
        ours, theirs = (x.astype(str).sort_values(list(x.columns)).reset_index(drop=True) for x in (found[name], whole))
        assert ours.equals(theirs), name
    touched = lake.load("silver", "api_calls").filter(on_dates("event_date", dates))
    folders = {f.rpartition("/")[0].rpartition("event_date=")[2] for f in touched.inputFiles()}
    assert folders == {"__HIVE_DEFAULT_PARTITION__" if d is None else str(d) for d in dates}
    assert touched.select("event_date").distinct().count() == len(dates)


def test_refresh_builds_every_table(spark, sf_dir, tmp_path):
    lake = Lake(spark, "full_")
    lake.create()
    calls = fixtures.calls(spark, sf_dir)
    lake.materialize(calls.withColumn("ingested_at", F.current_timestamp()), "bronze", "api_calls_historical")
    lake.materialize(fixtures.prices(spark), "bronze", "model_pricing")
    lake.materialize(fixtures.feedback(spark, sf_dir), "bronze", "quality_feedback")
    assert not lake.exists("bronze", "api_calls_live")
    counted = refresh.refresh_silver(lake)
    assert counted["api_calls"]["records"] == 6000 and counted["api_calls"]["all_rules"] == 0
    assert counted["quality_feedback"] == {"records": 1000, "valid_feedback_model": 0, "valid_thumbs": 0, "all_rules": 0}
    refresh.refresh_gold(lake)
    refresh.refresh_models(lake, str(tmp_path / "model"), maxIter=3)
    refresh.refresh_alerts(lake)
    refresh.refresh_alerts(lake)

    listed = {(r["layer"], r["table_name"]) for r in lake.layer_tables().collect()}
    wanted = {(layer, t) for layer, tables in TABLES.items() for t in tables}
    wanted -= {("bronze", "api_calls_live"), ("bronze", "refused_files")}
    assert listed == wanted

    direct = gold.daily_cost_by_team(silver.api_calls(calls, fixtures.prices(spark)))
    stored = lake.load("gold", "daily_cost_by_team").drop("gold_loaded_at")
    assert stored.exceptAll(direct).isEmpty() and direct.exceptAll(stored).isEmpty()
    assert lake.load("gold", "cost_predictions").count() % 30 == 0
    figures = {r.metric: r.value for r in lake.load("gold", "project_summary").collect()}
    assert figures["Total API calls processed"] == 6000 and figures["Days of cost forecasted"] == 30


def test_unknown_table_name(spark):
    with pytest.raises(KeyError):
        Lake(spark).name("gold", "nothing")
