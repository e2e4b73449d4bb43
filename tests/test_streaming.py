import json

from tallyworks.sources import files
from tallyworks.streaming import clicks

OUT = """ip STRING, user_id BIGINT, session_id STRING, event_time STRING, event_name STRING,
         channel STRING, metadata STRUCT<query: STRING>, user_query STRING"""


def event(user, query):
    return {
        "ip": "192.0.2.1", "user_id": user, "user_agent": "agent", "session_id": f"s{user}",
        "event_time": "01/01/2024 10:00:00", "event_name": "Search", "channel": "Direct",
        "metadata": {"query": query} if query else {},
    }


def drop_file(folder, name, events):
    """One array of events per file, written aside and renamed."""
    folder.mkdir(exist_ok=True)
    aside = folder.parent / f"{name}.part"
    aside.write_text(json.dumps(events))
    aside.rename(folder / name)


def test_stream_resumes_after_its_checkpoint(spark, rows, tmp_path):
    source = tmp_path / "in"
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    drop_file(source, "a.json", [event(1, "shoes"), event(2, None)])
    clicks.run_available(spark, str(source), out, checkpoint)
    result = files.json_lines(spark, out, OUT)
    assert rows(result, "user_id", "user_query") == [(1, "shoes"), (2, None)]
    drop_file(source, "b.json", [event(3, "hats")])
    clicks.run_available(spark, str(source), out, checkpoint)
    clicks.run_available(spark, str(source), out, checkpoint)
    assert rows(files.json_lines(spark, out, OUT), "user_id") == [(1,), (2,), (3,)]


def test_projection_is_the_same_for_a_batch(spark, rows, tmp_path):
    source = tmp_path / "in"
    drop_file(source, "a.json", [event(1, "shoes")])
    batch = clicks.project_clicks(spark.read.schema(clicks.schemas.CLICK_EVENT).json(str(source)))
    stream = clicks.project_clicks(clicks.read_clicks(spark, str(source)))
    assert stream.isStreaming and stream.columns == batch.columns
    assert "user_agent" not in batch.columns
    assert rows(batch, "session_id", "user_query") == [("s1", "shoes")]


def test_parquet_and_console_sinks(spark, tmp_path):
    source = tmp_path / "in"
    drop_file(source, "a.json", [event(1, "shoes"), event(2, "hats")])
    stream = clicks.read_clicks(spark, str(source), files_per_trigger=1)
    query = clicks.start_job(
        stream, "to_parquet", str(tmp_path / "c1"), str(tmp_path / "out"), "parquet", True
    )
    query.awaitTermination()
    assert query.name == "to_parquet"
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    console = clicks.start_job(stream, "to_console", str(tmp_path / "c2"), available_now=True)
    console.awaitTermination()
    assert console.exception() is None
