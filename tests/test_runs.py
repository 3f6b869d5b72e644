"""Folders in, charts out: whole runs on authored transcripts."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from callsift.plans.run import COMPLETE, FAILED, Context, Providers, Run, latest_run, pseudonymize, read_calls, run_pipeline
from callsift.providers.offline import RuleModel
from callsift.settings import Settings
from callsift.sources import tables
from callsift.sources.transcripts import ingest

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests
TOPICS = ("invoice billing charge invoice refund", "login password outage error broken", "renewal contract pricing quarter license", "sprint backlog standup roadblock hiring")


def call(root, name, lines, meeting=True, month="02", **more):
    folder = root / name
    folder.mkdir(parents=True)
    data = [
        {"index": i, "speaker_id": i % 2, "speaker_name": ("Ann Lee", "Bo Ray")[i % 2], "sentence": s, "time": float(i), "endTime": i + 0.5, "averageConfidence": 0.9, "sentimentType": "neutral", "junk": 1}
        for i, s in enumerate(lines)
    ]
    (folder / "transcript.json").write_text(json.dumps({"data": data} | more))
    if meeting:
        (folder / "meeting-info.json").write_text(json.dumps({"startTime": f"2026-{month}-10T10:00:00Z", "endTime": "", "duration": 30.0, "title": "x"}))


def corpus(root):
    for i in range(24):
        words = TOPICS[i % 4]
        call(root, f"CALL{i:02d}", [f"{words} thanks great, I wish this feature was here", f"mail ann{i}@example.org about {words}", "we saw a problem with it"], month=("02", "03")[i % 2])
    (root / "EMPTY").mkdir()


def test_ingest(spark, tmp_path):
    corpus(tmp_path)
    transcripts, utterances = ingest(spark, str(tmp_path))
    rows = {r.transcript_id: r for r in transcripts.collect()}
    assert len(rows) == 24 and "EMPTY" not in rows
    r = rows["CALL03"]
    raw = (tmp_path / "CALL03" / "transcript.json").read_bytes()
    assert r.size_bytes == len(raw) and r.utterance_count == 3 and r.end_time is None and r.transcript_month == "2026-03"
    assert r.relative_path == "CALL03/transcript.json"
    assert utterances.count() == 72


@pytest.mark.parametrize("case", ["nothing", "no meeting", "no lines", "no start"])
def test_ingest_errors(spark, tmp_path, case):
    if case == "no meeting":
        call(tmp_path, "A", ["x"])
        call(tmp_path, "B", ["x"], meeting=False)
    elif case == "no lines":
        call(tmp_path, "A", [])
    elif case == "no start":
        call(tmp_path, "A", ["x"])
        (tmp_path / "A" / "meeting-info.json").write_text("{}")
    with pytest.raises(Exception):
        for df in ingest(spark, str(tmp_path)):
            df.collect()


class Broken(RuleModel):
    def ask(self, task, instructions, prompt):
        if task == "findings":
            raise RuntimeError("no answer")
        return super().ask(task, instructions, prompt)


def test_run_fails_resumes_and_repeats(spark, tmp_path):
    corpus(tmp_path / "in")
    settings = Settings(llm_maximum_attempts=1, maximum_segment_tokens=40)
    with pytest.raises(Exception, match="no answer"):
        run_pipeline(spark, str(tmp_path / "in"), tmp_path / "out", settings, Providers(model=Broken()))
    state = json.loads((tmp_path / "out" / "execution_0" / "state.json").read_text())
    assert state["status"] == FAILED and state["stages"]["sentiment"] == FAILED and state["stages"]["topic_labels"] == COMPLETE
    run = run_pipeline(spark, str(tmp_path / "in"), tmp_path / "out", settings)
    assert run.directory.name == "execution_0" and run.state["status"] == COMPLETE
    second = run_pipeline(spark, str(tmp_path / "in"), tmp_path / "out", settings)
    assert second.directory.name == "execution_1"
    read = lambda r, stage, name: tables.read_table(spark, r.stage_dir(stage), name)
    first, again = (sorted(map(str, read(r, "aggregation", "metrics").collect())) for r in (run, second))
    assert first and first == again
    metrics, rows = read(run, "aggregation", "metrics"), read(run, "aggregation", "metric_contributors")
    counts = rows.groupBy("chart_point_id").agg(F.count("*").alias("n"))
    assert metrics.join(counts, "chart_point_id", "left").where("n is null or n <> numerator").count() == 0
    text = " ".join(r.sentence for r in read(run, "privacy", "redacted_utterances").collect())
    assert "@example.org" not in text and "[EMAIL_ADDRESS_01]" in text
    html = run.directory / "analytical_stage"
    manifest = json.loads((html / "chart_manifest.json").read_text())
    assert all((html / p).exists() for p in manifest.values()) and len(manifest) >= 4


def test_mappings_are_not_read_back(spark, tmp_path, monkeypatch):
    corpus(tmp_path / "in")
    c = Context(spark, str(tmp_path / "in"), Run(tmp_path / "run"), Settings(), Providers(), ("ingest",))
    read_calls(c)
    read, names = tables.read_table, []
    monkeypatch.setattr(tables, "read_table", lambda session, place, name: names.append(name) or read(session, place, name))
    c.owns = ("privacy",)
    pseudonymize(c)
    assert "redaction_reports" in names and "pii_mappings" not in names  # one folder a call: its listing grows with the calls
    mails = {r.transcript_id: r.surface for r in read(spark, c.run.stage_dir("privacy"), "pii_mappings").where("placeholder = '[EMAIL_ADDRESS_01]'").collect()}
    assert mails == {f"CALL{i:02d}": f"ann{i}@example.org" for i in range(24)}


@pytest.mark.parametrize("most", [3, 1000])
def test_folders_of_calls_are_written_by_bounded_jobs(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(tables, "FOLDERS_AT_ONCE", most)
    place = tmp_path / "pii_mappings"
    for n in (5, 40):  # the second replaces the first
        rows = [(f"0{i}" if i % 2 else f"{i}/ é", f"[EMAIL_ADDRESS_{k:02d}]", f"{i}.{k}@x.org") for i in range(n) for k in range(3)]
        tables.write_table(spark.createDataFrame(rows, tables.SCHEMAS["pii_mappings"]).repartition(4), str(tmp_path), "pii_mappings")
        assert sorted(map(tuple, tables.read_table(spark, str(tmp_path), "pii_mappings").select("transcript_id", "placeholder", "surface").collect())) == sorted(rows)
    folders = [p for p in place.iterdir() if p.is_dir()]
    assert len(folders) == 40 and all(len(list(p.glob("*.parquet"))) == 1 for p in folders)
    assert {p.name for p in tmp_path.iterdir()} == {"pii_mappings"}
    jobs = {p.name.split("-")[2] for d in folders for p in d.glob("*.parquet")}
    assert len(jobs) == 1 if most == 1000 else len(jobs) > 10


def test_runs_sort_by_number(tmp_path):
    for n in (9, 10):
        Run(tmp_path / f"execution_{n}").record(COMPLETE)
    assert latest_run(tmp_path).directory.name == "execution_11"
    assert latest_run(tmp_path).directory.name == "execution_11"  # it is not complete


def test_json_lines(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    good = {"transcript_id": "t", "source_set": "account-manager", "confidence": 0.5, "rationale": "r", "low_confidence": True}
    path.write_text(json.dumps(good) + "\n\n")
    assert tables.read_json_lines(spark, str(path), "classifications").count() == 1
    path.write_text(json.dumps(good | {"more": 1}) + "\n")
    with pytest.raises(Exception, match="unknown fields"):
        tables.read_json_lines(spark, str(path), "classifications").collect()


def test_streaming_equals_batch(spark, tmp_path):
    from callsift.operators.segments import segment_ordinals
    from callsift.streaming.rates import monthly_counts, streaming_segments

    rows = [(f"c{i % 3}", i // 3, 40 + 30 * (i % 5), i % 7 == 3) for i in range(60)]
    batch = spark.createDataFrame(rows, "transcript_id string, order long, tokens long, shift boolean")
    batch.repartition(1).write.parquet(str(tmp_path / "turns"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "turns"))
    query = streaming_segments(stream, 120).writeStream.format("memory").queryName("cut").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    want = segment_ordinals(batch, 120).select("transcript_id", "order", "segment")
    assert sorted(map(tuple, spark.table("cut").collect())) == sorted(map(tuple, want.collect()))
    events = spark.createDataFrame([("2024-01-02", "a"), ("2024-01-02", "a"), ("2024-02-03", "b")], "d string, k string").select(F.col("d").cast("timestamp").alias("ts"), "k")
    events.repartition(1).write.parquet(str(tmp_path / "events"))
    live = monthly_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")), "ts", ["k"])
    query = live.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r.month, r.k, r.n) for r in spark.table("counts").collect()} == {("2024-01", "a", 2), ("2024-02", "b", 1)}


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
