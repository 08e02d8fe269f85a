import json

from intakeyard.streaming import intake

GOOD = {"id": "a", "website": None, "name": "A", "founded": 1, "size": None, "locality": None,
        "region": None, "country": None, "industry": None, "linkedin_url": None}


def test_stream_validates_landed_files(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "f1.jsonl").write_text(json.dumps(GOOD) + "\n" + '{"id": ""}\n' + "not json\n")
    (landing / "f2.jsonl").write_text(json.dumps({**GOOD, "id": "b"}) + "\n")
    out = str(tmp_path / "out")
    q = intake.start(spark, str(landing), out, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    accepted = sorted(r.id for r in spark.read.parquet(f"{out}/accepted").collect())
    assert accepted == ["a", "b"]
    v = {r.rule: r.n_lines for r in spark.read.parquet(f"{out}/violations").groupBy("rule").sum("n_lines")
         .withColumnRenamed("sum(n_lines)", "n_lines").collect()}
    assert v == {"malformed JSON": 1, "unexpected field set: id": 1}


def test_restart_reads_nothing_twice(spark, tmp_path, monkeypatch):
    """The default checkpoint has the same name in every process, so a restart goes on where it was."""
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    monkeypatch.setattr(intake, "scratch_root", lambda _: str(tmp_path / "shared"))
    (landing / "f1.jsonl").write_text(json.dumps(GOOD) + "\n")
    intake.start(spark, str(landing), out).awaitTermination(120)
    (landing / "f2.jsonl").write_text(json.dumps({**GOOD, "id": "b"}) + "\n")
    intake.start(spark, str(landing), out).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(f"{out}/accepted").collect()) == ["a", "b"]
