"""Split CSV files, inferred types, snapshots and reconciled writes."""

import csv
import json
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from riskframe.catalog import QUERIES, Tables
from riskframe.sources import csv_split, inference
from riskframe.sources import files as io
from riskframe.sources.snapshots import SnapshotStore, write_reconciled

random.seed(17)
SCHEMA = "id long, note string, amount double, day date"


def write_file(path, rows, end="\n", header=("id", "note", "amount", "day")):
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator=end)
        if header:
            writer.writerow(header)
        writer.writerows(rows)


def awkward_notes(n):
    pieces = ["plain", ",", '"', "\n", "\n\n", "a,b", '""', "é你", " ", "\r\n", "'", "x" * 300, "\n" * 40]
    return ["".join(random.choices(pieces, k=random.randint(1, 12))) for _ in range(n)]


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_file_equals_the_whole_one(spark, tmp_path, small_ranges, end):
    rows = [(i, note, i / 4, f"2024-01-{1 + i % 28:02d}") for i, note in enumerate(awkward_notes(120))]
    # a record longer than several ranges, and one whose header-like text fools nobody
    rows[7] = (7, "\n".join(["long, \"line\""] * 300), 1.5, "2024-02-01")
    rows[8] = (8, "id,note,amount,day", None, "")
    write_file(tmp_path / "a.csv", rows[:70], end)
    write_file(tmp_path / "b.csv", rows[70:], end)
    path = str(tmp_path)
    split = io.read_csv(spark, path, SCHEMA, whole_files=False)
    assert {r.id: r.note for r in split.collect()} == {i: n for i, n, _, _ in rows}
    assert split.count() == 120
    if end == "\n":  # the built-in reader takes the line ends inside quotes for those of the file otherwise
        assert split.exceptAll(io.read_csv(spark, path, SCHEMA, whole_files=True)).count() == 0
    # many tasks read the two files, and large files are found to be large
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    assert io.oversized(spark, [path]) and "from_csv" in plan_of(io.read_csv(spark, path, SCHEMA))


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_split_file_without_header_or_end(spark, tmp_path, small_ranges):
    rows = [(i, note) for i, note in enumerate(awkward_notes(60))]
    write_file(tmp_path / "a.csv", rows, header=None)
    with open(tmp_path / "a.csv", "a") as f:
        f.write('\n\n500,"never ends\nat all')
    got = io.read_csv(spark, str(tmp_path), "id long, note string", header=False, whole_files=False)
    found = {r.id: r.note for r in got.collect()}
    assert found.pop(500).startswith("never ends\nat all") and found == dict(rows)


def test_split_file_with_wrong_rows_and_headers(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text('day,id,amount,note\n2024-01-01,1,2.5,"a\nb"\nno day,2,x,c\n')
    got = io.read_csv(spark, str(tmp_path / "a"), SCHEMA, corrupt="bad", whole_files=False).orderBy("id").collect()
    assert [(r.id, r.note, r.amount, r.bad) for r in got] == [(1, "a\nb", 2.5, None), (2, "c", None, "no day,2,x,c")]
    (tmp_path / "a" / "y.csv").write_text("id,day,amount,note\n")
    with pytest.raises(Exception, match="was expected"):
        io.read_csv(spark, str(tmp_path / "a"), SCHEMA, whole_files=False).collect()
    with pytest.raises(ValueError, match="no column"):
        io.read_csv(spark, str(tmp_path / "a"), SCHEMA + ", more int", whole_files=False)
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "x.csv").write_text("id,note,amount,day\n")
    assert io.read_csv(spark, str(tmp_path / "e"), SCHEMA, whole_files=False).count() == 0


def test_too_many_ranges_are_read_whole(spark, tmp_path, monkeypatch):
    write_file(tmp_path / "a.csv", [(1, "x\ny", 1.0, "")])
    monkeypatch.setattr(csv_split, "BROADCAST_RANGES", 0)
    df = io.read_csv(spark, str(tmp_path), SCHEMA, whole_files=False)
    assert "from_csv" not in plan_of(df) and df.first().note == "x\ny"


def test_size_settings():
    assert [io.in_bytes(x) for x in ("128MB", "134217728b", "64k", "700", "1g")] == [1 << 27, 1 << 27, 1 << 16, 700, 1 << 30]


@pytest.mark.parametrize("name, columns", [("scan_csv_columns", "o_orderkey:bigint,o_orderstatus:string,o_totalprice:double"), ("scan_csv_key", "o_orderkey:bigint")])
def test_csv_scan_is_pruned(spark, sf_dir, name, columns):
    plan = QUERIES[name].run(Tables(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and f"ReadSchema: struct<{columns}>" in plan


# ---------------------------------------------------------------- types
def brute_type(values):
    import datetime
    import re

    values = [v for v in values if v is not None]
    fits = lambda p: all(re.fullmatch(p, v) for v in values)

    def dates(parse):
        try:
            return all(parse(v) for v in values)
        except ValueError:
            return False

    if not values:
        return "string"
    if fits("(?i:true|false)"):
        return "boolean"
    if fits("[+-]?[0-9]+") and all(-(1 << 63) <= int(v) < 1 << 63 for v in values):
        return "bigint"
    if fits(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"):
        return "double"
    if fits(r"\d{4}-\d\d-\d\d") and dates(datetime.date.fromisoformat):
        return "date"
    if fits(r"\d{4}-\d\d-\d\d([ T]\d\d:\d\d(:\d\d(\.\d{1,6})?)?)?") and dates(datetime.datetime.fromisoformat):
        return "timestamp"
    return "string"


def test_types_of_all_values(spark, tmp_path):
    pools = [
        ["1", "-2", "+3", "007"], ["1", "2.5", "1e3", ".5", "7."], ["true", "FALSE"], ["2024-01-31", "2023-12-01"],
        ["2024-01-31", "2024-01-31 10:20", "2024-01-31T10:20:30.5"], ["x", "1"], ["99999999999999999999"], ["true", "1"], ["2024-01-31", "5"], ["2024-02-31"], [" 1"],
    ]
    columns = [[random.choice([*pool, None]) for _ in range(300)] for pool in pools] + [[None] * 300]
    # one odd value in the last row widens a column
    columns += [["1"] * 299 + ["1.5"], ["1.5"] * 299 + ["?"], ["2024-01-01"] * 299 + ["2024-01-01 00:00:01"], ["1"] * 299 + ["yes"]]
    names = [f"c {i}" for i in range(len(columns))]
    df = spark.createDataFrame(list(zip(*columns)), ", ".join(f"`{n.replace('`', '``')}` string" for n in names)).repartition(7)
    states = inference.column_states(df)
    got = {r["column"]: (r["type"], r["filled"]) for r in inference.with_types(states).collect()}
    assert got == {n: (brute_type(c), sum(v is not None for v in c)) for n, c in zip(names, columns)}
    # states of parts merge to the state of the whole, in any order
    parts = [inference.column_states(df.where(F.spark_partition_id() == i)) for i in (3, 0, 6, 1, 5, 2, 4)]
    assert sorted(inference.merge_states(*parts).collect()) == sorted(states.select("column", "position", "state", "filled").collect())
    io.write_csv(df, str(tmp_path / "t"))
    back = inference.read_csv_inferred(spark, str(tmp_path / "t"))
    assert [f.dataType.simpleString() for f in back.schema] == [brute_type(c) for c in columns]
    assert back.count() == 300 and back.select(F.sum(back.columns[0])).first()[0] == sum(int(v) for v in columns[0] if v)


# ---------------------------------------------------------------- snapshots
def test_versions_are_published_together(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    assert store.keys().count() == 0 and store.versions() == []
    assert store.publish({"a": spark.range(3), "b": spark.range(5)}) == 1
    assert store.publish({"b": spark.range(7), "c": spark.range(0)}) == 2
    assert sorted(tuple(r) for r in store.keys().collect()) == [("a", 1, 3), ("b", 2, 7), ("c", 2, 0)]
    assert sorted(tuple(r) for r in store.keys(1).collect()) == [("a", 1, 3), ("b", 1, 5)]
    assert store.read("b").count() == 7 and store.read("b", 1).count() == 5 and store.read("c", columns=["id"]).count() == 0
    # a writer that fails in its second table leaves the last version as it was
    broken = spark.range(4).select(F.raise_error(F.lit("no more")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no more"):
        store.publish({"a": spark.range(100), "d": broken})
    assert store.versions() == [1, 2] and store.read("a").count() == 3
    with pytest.raises(ValueError, match="no table d"):
        store.read("d")
    with pytest.raises(ValueError, match="no version 9"):
        store.read("a", 9)
    assert store.publish({}, drop=("a",)) == 3 and [r.key for r in store.keys().collect()] == ["b", "c"]
    assert store.read("a", 2).count() == 3
    # what only dropped versions list goes
    assert store.expire(1) == 2 and store.versions() == [3] and store.read("b").count() == 7


def test_writers_at_the_same_time_follow_each_other(spark, tmp_path):
    base = str(tmp_path / "s")
    done = []
    threads = [threading.Thread(target=lambda i=i: done.append(SnapshotStore(spark, base).publish({f"k{i}": spark.range(i)}))) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    store = SnapshotStore(spark, base)
    assert sorted(done) == [1, 2, 3, 4] == store.versions()
    assert {r.key: r.n_rows for r in store.keys().collect()} == {f"k{i}": i for i in range(4)}
    assert not [n for n in os.listdir(f"{base}/manifests") if n.startswith("pending")]
    # a manifest that is not renamed yet is no version
    with open(f"{base}/manifests/pending-x", "w") as f:
        json.dump({"version": 5, "tables": {}}, f)
    assert store.versions()[-1] == 4


# ---------------------------------------------------------------- reconciled writes
def test_counts_come_from_the_write(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            read.add(len(b))
            yield b

    source = spark.range(0, 100, 1, 4).mapInArrow(touch, "id long")
    path = str(tmp_path / "out")
    counts = write_reconciled(source, F.when(F.col("id") == 50, None).otherwise(F.col("id") >= 10), path, {"even": F.col("id") % 2 == 0, "odd": F.col("id") % 2 == 1})
    assert counts == {"n_source": 100, "n_rejected": 11, "n_written": 89, "even": 44, "odd": 45}
    assert read.value == 100  # one pass over the source
    assert spark.read.parquet(path).count() == 89
    with pytest.raises(ValueError, match="exists"):
        write_reconciled(source, F.lit(True), path)


def test_what_does_not_reconcile_is_not_published(spark, tmp_path):
    df, path = spark.range(20), str(tmp_path / "out")
    with pytest.raises(ValueError, match="do not add up"):
        write_reconciled(df, F.lit(True), path, {"low": F.col("id") < 10, "high": F.col("id") > 10})
    broken = df.select(F.when(F.col("id") == 13, F.raise_error(F.lit("bad batch")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="bad batch"):
        write_reconciled(broken, F.lit(True), path)
    assert os.listdir(tmp_path) == []
    assert write_reconciled(df.limit(0), F.lit(True), path) == {"n_source": 0, "n_rejected": 0, "n_written": 0}
