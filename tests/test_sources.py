import gzip
import io
import json
import sqlite3
import tarfile

import pytest
from pyspark.sql import functions as F

from brindle import cli, config
from brindle.plans import runs
from brindle.schemas import COMPLETION, PACKAGE, SCRAPE
from brindle.sources import readers, sinks
from brindle.streaming import events


def test_lists_and_json(spark, tmp_path):
    f = tmp_path / "names.txt"
    f.write_text("a\n\n  b \n")
    assert sorted(r.name for r in readers.names_of(spark, str(f)).collect()) == ["a", "b"]
    assert readers.names_of(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.names_of(spark, str(tmp_path / "none"), required=True)
    j = tmp_path / "x.jsonl"
    j.write_text('{"a": 1}\n{bad\n{"a": 2}\n')
    assert sorted(r.a for r in readers.json_lines(spark, str(j), "a int").collect()) == [1, 2]
    assert readers.newest_file(spark, str(tmp_path / "*.jsonl")).endswith("x.jsonl") and readers.newest_file(spark, str(tmp_path / "*.none")) is None


def test_archives_and_trees(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as tar:
        for name, body in (("p/test.rs", b"fn a() {}"), ("p/bad.rs", b"\xff"), ("p/README", b"r")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    (tmp_path / "b.tar.gz").write_bytes(gzip.compress(b"no tar"))
    got = {(r.path, r.text, r.error is None) for r in readers.archives(spark, str(tmp_path / "*.tar.gz")).collect()}
    assert {("p/test.rs", "fn a() {}", True), ("p/bad.rs", None, True), ("p/README", None, True)} < got and len(got) == 4
    for name in ("src/x.rs", "target/y.rs", "z.txt"):
        (tmp_path / "t" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "t" / name).write_text("text")
    assert readers.source_tree(spark, str(tmp_path / "t")).count() == 1
    toml = spark.createDataFrame([("a", "[package]\nname = 'x'"), ("b", "= bad")], "path string, text string")
    assert [json.loads(r.manifest)["package"]["name"] if r.manifest else None for r in readers.manifests(toml).orderBy("path").collect()] == ["x", None]


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "x.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE t (a INTEGER, b TEXT)")
        db.executemany("INSERT INTO t VALUES (?, ?)", [(i, str(i)) for i in range(25)])
    assert readers.sqlite_tables(path) == {"t": ["a", "b"]}
    assert readers.sqlite_table(spark, path, "t", "a bigint, b string", chunk=10).count() == 25


def test_landing_and_retry(tmp_path):
    calls, slept = [], []

    def fetch(url):
        calls.append(url)
        if len(calls) < 3:
            raise OSError
        return b"x"

    assert readers.land({"f": "u"}, str(tmp_path), fetch=fetch) == [] and len(calls) == 3
    assert readers.land({"f": "u"}, str(tmp_path), fetch=fetch) == [] and len(calls) == 3
    assert readers.with_retry(lambda: None, 3, slept.append) is None and slept == [1.0, 2.0]


def test_checkpoints(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, None, 1.0, "ok", None)], COMPLETION)
    for batch in (0, 1, 1):
        sinks.checkpoint(df, str(tmp_path), batch)
    assert sinks.checkpointed(spark, str(tmp_path), COMPLETION).count() == 2
    assert not sinks.audit(df.limit(0), str(tmp_path)) and sinks.audit(df, str(tmp_path))


def test_runs(spark, tmp_path):
    landed = tmp_path / "landed.jsonl"
    landed.write_text("\n".join(json.dumps({"name": n, "readme": "# T\ntext", "dependencies": [{"crate_id": "a", "kind": "normal"}]}) for n in "ab"))
    data = readers.json_lines(spark, str(landed), PACKAGE)
    names = spark.createDataFrame([("a",), ("b",), ("none",)], "name string")
    out = runs.batch_run(names, data, config.Config(), root=str(tmp_path / "out"))
    assert out["packages"].count() == 2 and out["depended"].first().n == 2
    assert spark.read.json(str(tmp_path / "out/summary")).first().total == 2
    scrapes = spark.createDataFrame([("a", "docs", "u", "t", "x", 9.0, "m", None, None, None), ("b", "docs", "u", None, None, 0.0, "failed", None, "boom", None)], SCRAPE)
    traces = {r.name: r.verdict for r in runs.trace_run(spark, scrapes, config.Config(), str(tmp_path / "tr")).collect()}
    assert traces == {"a": "ALLOW", "b": "DEFER"}
    assert runs.verification_run(data, data, 5)["summary"].first().verified == 2
    kb = runs.knowledge_run(spark, str(tmp_path / "kb"), code_root=str(tmp_path.parent))
    assert kb["code_changes"].count() == 0
    (tmp_path / "names.txt").write_text("a\n")
    assert cli.main(["--output-dir", str(tmp_path / "cli"), "run", "--landed", str(landed), "--names", str(tmp_path / "names.txt")]) == 0


def test_config(tmp_path, monkeypatch):
    f = tmp_path / "c.json"
    f.write_text('{"batch_size": 7}')
    monkeypatch.setenv("BRINDLE_SKIP_ENRICHMENT", "yes")
    got = config.load(str(f), production=True, flags={"max_tokens": 9, "model": None})
    assert (got.batch_size, got.max_retries, got.max_tokens, got.skip_enrichment) == (7, 2, 9, True)
    with pytest.raises(ValueError):
        config.Config(batch_size=0)
    with pytest.raises(ValueError):
        config.Thresholds(deny=0.9)
    with pytest.raises(ValueError):
        config.load(flags={"unknown": 1})


def test_streaming(spark, data, tmp_path):
    source = tmp_path / "in"
    frame = spark.read.parquet(f"{data}/events.parquet")
    frame.write.parquet(str(source))
    stream = events.arriving(spark, str(source), frame.schema)
    query = events.processed(stream, lambda b: b.where("value > 10"), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == frame.where("value > 10").count()
    counted = events.throughput(events.arriving(spark, str(source), frame.schema).withColumn("ts", F.col("ts").cast("timestamp")))
    q = counted.writeStream.outputMode("complete").format("memory").queryName("rate").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT sum(n) FROM rate").first()[0] == frame.count()


def test_output_folders(spark, tmp_path):
    root = "file://" + str(tmp_path)
    made = sinks.output_dir(spark, root, when=0)
    assert made == f"{root}/output_19700101_000000" and readers.exists(spark, made)
    assert sinks.removed(spark, made) and not sinks.removed(spark, made) and sinks.space_left(spark, root, 0.0) and not sinks.space_left(spark, root, 1e9)
    events = spark.createDataFrame([(k, "error" if k % 2 else "info", f"m{k}") for k in range(30)], "k long, status string, message string")
    sinks.status_messages(events.where("status = 'error'"), "k", f"{root}/status", 3)
    assert [list(r.messages) for r in spark.read.json(f"{root}/status").collect()] == [["m25", "m27", "m29"]]
