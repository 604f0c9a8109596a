import json

from tests.conftest import rows

from foliomill.streaming import journals


def write(folder, name, records):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps(dict(zip(("source_identifier", "document_url", "status", "sha256", "recorded_at"), r))) for r in records]
    (folder / name).write_text("\n".join([*lines, '{"broken']) + "\n")


def test_latest_state_over_runs(spark, tmp_path):
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    write(folder, "1.jsonl", [("a", "u", "failed", None, "2024-01-01T00:00:00Z"), ("b", "u", "stored", "s", "2024-01-01T00:00:00Z")])
    journals.keep_latest(journals.journal_stream(spark, str(folder)), out, check).awaitTermination(120)
    write(folder, "2.jsonl", [("a", "u", "stored", "t", "2024-01-02T00:00:00Z"), ("b", "u", "failed", None, "2023-01-01T00:00:00Z")])
    journals.keep_latest(journals.journal_stream(spark, str(folder)), out, check).awaitTermination(120)
    got = rows(spark.read.parquet(f"{out}/batch=1").select("source_identifier", "status", "sha256"))
    assert got == [("a", "stored", "t"), ("b", "stored", "s")]


def run(spark, df, name, mode):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    query.processAllAvailable()
    query.stop()
    return rows(spark.table(name))


def test_windows_and_breaker(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "1.jsonl", [("a", f"u{i}", "failed", None, f"2024-01-01T0{i}:10:00Z") for i in range(6)] + [("b", "u", "stored", "s", "2024-01-01T00:20:00Z")])
    counts = run(spark, journals.status_windows(journals.journal_stream(spark, str(folder))), "windows", "complete")
    assert [r[1:] for r in counts].count(("failed", 1)) == 6 and [r[1:] for r in counts].count(("stored", 1)) == 1
    state = run(spark, journals.breaker(journals.journal_stream(spark, str(folder))), "breaker", "update")
    assert state == [("a", 6, True), ("b", 0, False)]
    once = run(spark, journals.once_each(journals.journal_stream(spark, str(folder))), "once", "append")
    assert len(once) == 7
