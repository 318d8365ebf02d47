import csv
import io
import json
import random
import sqlite3
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import modelling
from millrace.sources import delimited, payload, sinks, sqlite, tables


def test_csv_types_and_missing_marks(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("id,score,flag,when,note\n1,2.5,True,2020-01-01,hi\n2,NA,False,2020-02-01,\n3,4,,n/a,None\n")
    df = tables.load_table(spark, str(p), "csv")
    assert df.dtypes == [
        ("id", "bigint"), ("score", "double"), ("flag", "boolean"), ("when", "string"), ("note", "string")
    ]
    got = [tuple(r) for r in df.orderBy("id").collect()]
    assert got == [(1, 2.5, True, "2020-01-01", "hi"), (2, None, False, "2020-02-01", None), (3, 4.0, None, None, None)]
    assert tables.shape(df) == (3, 5)
    assert [r["id"] for r in tables.preview(df, ["id"], 2).collect()] == [1, 2]


def test_csv_with_schema(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b\n1,x\nNaN,y\n")
    df = tables.load_csv(spark, str(p), "a double, b string")
    assert [tuple(r) for r in df.collect()] == [(1.0, "x"), (None, "y")]


def test_payload_json_then_csv(spark, tmp_path):
    good, bad = tmp_path / "a.json", tmp_path / "b.json"
    good.write_text(json.dumps([{"a": 1, "b": "x"}, {"a": 2, "b": None}]))
    bad.write_text("a,b\n1,x\n2,y\n")
    assert sorted(tuple(r) for r in tables.load_table(spark, str(good), "api").collect()) == [(1, "x"), (2, None)]
    assert sorted(tuple(r) for r in tables.load_payload(spark, str(bad)).collect()) == [(1, "x"), (2, "y")]


def test_jdbc_options():
    plain = tables.jdbc_options("jdbc:sqlite:x.db", "select 1")
    assert plain["query"] == "select 1" and "dbtable" not in plain
    split = tables.jdbc_options("jdbc:p", "select * from t", {"column": "id", "lower": 0, "upper": 9, "parts": 3})
    assert split["dbtable"] == "(select * from t) AS source" and split["numPartitions"] == "3" and "query" not in split
    with pytest.raises(ValueError):
        tables.jdbc_options("sqlite://x", "select 1")


def test_unknown_kind(spark):
    with pytest.raises(ValueError, match="excel"):
        tables.load_table(spark, "x", "excel")


def test_pushdown_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, 2.0, "a")], "k int, x double, s string").write.parquet(path)
    plan = tables.load_parquet(spark, path).filter("k > 3").select("k", "x")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k,3)" in plan and "ReadSchema: struct<k:int,x:double>" in plan


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_round_trip(spark, rows, tmp_path, kind):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, s string")
    path = sinks.save_table(df, str(tmp_path / kind), kind)
    sinks.save_table(df, path, kind)
    assert rows(tables.load_table(spark, path, kind), "k", "s") == [(1, "a"), (2, "b")]


def test_artefacts_by_run(spark, tmp_path):
    df = spark.range(2)
    for run in ("r1", "r2"):
        sinks.save_artefacts({"facts": df}, str(tmp_path), run)
    back = spark.read.parquet(str(tmp_path / "facts"))
    assert sorted({r["run_id"] for r in back.collect()}) == ["r1", "r2"]


def test_contract(spark, tmp_path):
    context = {"domain": "retail", "confidence_score": 0.5, "evidence_integrity": {"placeholder_count": 2}}
    path = sinks.write_contract(spark, str(tmp_path / "c"), "y", "regression", context)
    got = sinks.read_contract(spark, path).first()
    assert (got["target_column"], got["problem_type"]) == ("y", "regression")
    assert got["domain_context"]["evidence_integrity"]["placeholder_count"] == 2


def test_run_log_keeps_the_latest(spark, tmp_path):
    path = str(tmp_path / "log")
    sinks.append_run(spark, path, run_id="a", status="FAILED", ended_at="2020-01-01T00:00:00")
    sinks.append_run(spark, path, run_id="a", status="SUCCESS", ended_at="2020-01-02T00:00:00", rows_after=5)
    sinks.append_run(spark, path, run_id="b", status="FAILED", ended_at="2020-01-01T00:00:00")
    got = {r["run_id"]: (r["status"], r["rows_after"]) for r in sinks.read_runs(spark, path).collect()}
    assert got == {"a": ("SUCCESS", 5), "b": ("FAILED", None)}
    with pytest.raises(ValueError):
        sinks.append_run(spark, path, colour="red")


def test_model_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(9)], "x double, y double")
    fitted = modelling.train_baseline(df, ["x"], "y", "regression")
    back = sinks.load_model(sinks.save_model(fitted.model, str(tmp_path / "m")))
    assert back.transform(df).agg({"prediction": "sum"}).first()[0] == pytest.approx(72.0)


def test_staging_writes_to_the_shared_folder(spark, rows):
    df = spark.range(50_000).coalesce(1)
    out = sinks.stage(df, "t", rows=50_000)
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in out.inputFiles())
    assert len(out.inputFiles()) == 4 and out.count() == 50_000


def test_staging_needs_a_shared_folder_off_local():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        sinks.staging_root(Session())


def test_latest_run_ties(spark):
    at = datetime(2020, 1, 1)
    log = spark.createDataFrame([("a", 1, at), ("a", 2, at)], "run_id string, n int, ended_at timestamp_ntz")
    assert sinks.latest_runs(log, tie=("n",)).first()["n"] == 2


def _messy(n, seed, end):
    rng = random.Random(seed)
    field = lambda: rng.choice(["", "a", 'say ""hi""', "x,y", "two\nlines", "\r\n", ',""\n""', 'é"', "long " * 30])
    out = ["id,note,more"]
    for i in range(n):
        cells = [str(i)]
        for _ in range(2):
            f = field()
            # A quote inside a plain field is a character like any other.
            cells.append(f if f in ("", "a", 'é"') else f'"{f}"')
        out.append(",".join(cells))
    return end.join(out) + rng.choice(["", end])


@pytest.mark.parametrize("range_bytes", ["64", "1000", "128m"])
def test_line_breaks_in_quotes(spark, tmp_path, range_bytes):
    for i, end in enumerate(["\n", "\r\n"]):
        (tmp_path / f"{i}.csv").write_text(_messy(150, i, end), newline="")
    settings = {"spark.sql.files.maxPartitionBytes": range_bytes, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = tables.load_csv(spark, str(tmp_path))
        assert df.dtypes == [("id", "bigint"), ("note", "string"), ("more", "string")]
        got = sorted((tuple(r) for r in df.collect()), key=repr)
        if range_bytes != "128m":
            assert delimited.read_records(spark, str(tmp_path)).rdd.getNumPartitions() > 10
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = []
    for i in range(2):
        text = (tmp_path / f"{i}.csv").read_bytes().decode()
        want += [(int(r[0]), r[1] or None, r[2] or None) for r in list(csv.reader(io.StringIO(text, newline="")))[1:]]
    assert got == sorted(want, key=repr)


def test_line_states_follow_the_csv_rules():
    rng = random.Random(1)
    for _ in range(3000):
        line = "".join(rng.choices('",ab', k=rng.randrange(9)))
        for opening in ("", '"'):
            # The csv module joins lines while a field is open.
            rows = list(csv.reader([opening + line + "\n", "END"]))
            assert delimited.ends_inside(line, bool(opening)) == (rows[-1] != ["END"]), (line, opening)


def test_sqlite_in_parts_with_filters(spark, tmp_path):
    path = str(tmp_path / "a b.db")
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE t (k INTEGER PRIMARY KEY, x REAL, s, mixed, raw BLOB, none)")
    con.execute("CREATE TABLE plain (k TEXT PRIMARY KEY, n INT) WITHOUT ROWID")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, NULL)", [(i * 3, i / 4 if i % 5 else None, f"s{i % 7}", i if i % 2 else "t", b"\x00b") for i in range(1000)])
    con.execute("INSERT INTO plain VALUES ('a', 1), ('b', NULL)")
    con.commit()
    df = tables.load_table(spark, f"sqlite:///{path}|t", "database")
    assert df.dtypes == [("k", "bigint"), ("x", "double"), ("s", "string"), ("mixed", "string"), ("raw", "binary"), ("none", "string")]
    assert df.rdd.getNumPartitions() == sqlite.PARTS and df.count() == 1000
    some = df.filter((F.col("k") >= 30) & (F.col("k") < 300) & (F.col("s") == "s3") & F.col("x").isNotNull())
    want = con.execute("SELECT k, x, mixed FROM t WHERE k >= 30 AND k < 300 AND s = 's3' AND x IS NOT NULL").fetchall()
    assert sorted((r["k"], r["x"], r["mixed"]) for r in some.collect()) == sorted((k, x, str(m)) for k, x, m in want) and want
    reader = sqlite.SqliteReader(sqlite._types(path, '"t"'), {"path": path, "table": "t"})
    pushed = [sqlite.GreaterThan(("k",), 5), sqlite.In(("s",), ("s1", "s2")), sqlite.LessThan(("s",), "z"), sqlite.EqualTo(("x",), "no")]
    assert list(reader.pushFilters(pushed)) == pushed[2:]
    assert reader.tests == ['"k" > ?', 'cast("s" AS TEXT) IN (?, ?)'] and reader.values == [5, "s1", "s2"]
    query = tables.load_database(spark, f"sqlite:///{path}", "SELECT s, count(*) AS n FROM t GROUP BY s")
    assert query.rdd.getNumPartitions() == 1 and query.count() == 7
    assert sorted(tuple(r) for r in tables.load_database(spark, f"sqlite:///{path}", "plain").collect()) == [("a", 1), ("b", None)]
    con.close()


def _json_array(n, seed, indent):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choices(['"', "\\", "}", "{", "[", "]", "a", "\n", "é", ","], k=rng.randrange(12)))
    rows = [{"k": i, "s": text(), "deep": {"list": [{"x": text()}, {"x": None}], "n": i / 2}, "gone": None if i % 2 else text()} for i in range(n)]
    return rows, json.dumps(rows, indent=indent, ensure_ascii=bool(indent))


@pytest.mark.parametrize("range_bytes", ["50", "3000", "128m"])
def test_a_json_array_is_read_in_ranges(spark, tmp_path, range_bytes):
    want = []
    for i, indent in enumerate([None, 2]):
        rows, text = _json_array(120, i, indent)
        (tmp_path / f"{i}.json").write_text(text)
        want += rows
    settings = {"spark.sql.files.maxPartitionBytes": range_bytes, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        records = payload.read_objects(spark, str(tmp_path))
        if range_bytes != "128m":
            assert records.rdd.getNumPartitions() > 10
        got = [json.loads(r["record"]) for r in records.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    ours = tables.load_payload(spark, str(tmp_path))
    plain = spark.read.option("multiLine", True).json(str(tmp_path))
    assert ours.schema == plain.schema
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, plain.collect()))


def test_rows_are_numbered_alike_in_one_file_and_many(spark, tmp_path):
    df = spark.range(0, 5000, 1, 1).select(F.col("id").alias("k"), (F.col("id") * 7 % 11).alias("file"), (F.col("id") % 3).cast("double").alias("x"))
    for kind in ("parquet", "csv"):
        for name, per_file in (("one", 0), ("many", 100)):
            writer = df.coalesce(1).write.option("maxRecordsPerFile", per_file).option("header", True)
            writer.save(str(tmp_path / kind / name), format=kind)
            load = tables.load_parquet if kind == "parquet" else tables.load_csv
            got = load(spark, str(tmp_path / kind / name), position="position")
            assert got.columns == ["k", "file", "x", "position"]
            assert got.count() == 5000 and got.filter("k = position").count() == 5000
        assert len(list((tmp_path / kind / "many").glob("part-*"))) == 50
    with pytest.raises(ValueError, match="already has"):
        tables.load_parquet(spark, str(tmp_path / "parquet" / "one"), position="k")


def test_two_writers_of_the_run_log_lose_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    commit, late = sinks._commit, []

    def interleaved(*args):
        if not late:
            late.append(1)
            sinks.append_run(spark, path, run_id="other", status="SUCCESS", ended_at="2020-01-01T00:00:00")
        return commit(*args)

    monkeypatch.setattr(sinks, "_commit", interleaved)
    sinks.append_run(spark, path, run_id="own", status="FAILED", ended_at="2020-01-01T00:00:00")
    for i in range(3):
        sinks.append_run(spark, path, run_id="own", status="SUCCESS", ended_at=f"2020-01-02T00:00:0{i}", rows_after=i)
    got = {r["run_id"]: (r["status"], r["rows_after"]) for r in sinks.read_runs(spark, path).collect()}
    assert got == {"own": ("SUCCESS", 2), "other": ("SUCCESS", None)}
    assert len(list((tmp_path / "log").glob("snapshot-*"))) == len([f for f in (tmp_path / "log" / "commits").glob("0*")]) == 2
    assert sinks.read_runs(spark, str(tmp_path / "none")).count() == 0
