"""Risk jobs, sources and sinks, streams."""

import os
import uuid
from types import SimpleNamespace
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from riskframe.plans import risk
from riskframe.session import work_dir
from riskframe.sources import files as io
from riskframe.sources import records
from riskframe.streaming import monitors as M

ACCOUNTS = [
    ("Alice", 720, 15000, 20000, 0), ("Dave", 590, 4800, 5000, 3), ("Grace", 780, 5000, 40000, 0),
    ("Frank", 660, 12000, 12500, 1), ("Eve", 700, 9000, 25000, 0),
]
TRANSACTIONS = [
    (1, "Alice", 45.5, False, False), (2, "Bob", 6200.0, True, True), (3, "Alice", 4500.0, False, True),
    (4, "Eve", 8900.0, True, False), (5, "Frank", 2200.0, True, True), (6, "Bob", 340.0, False, False),
    (7, "Bob", 7600.0, True, True), (8, "Alice", 89.99, False, False),
]
TXN_SCHEMA = "txn_id int, customer string, amount double, is_foreign boolean, is_night boolean"


def test_account_scan(spark):
    df = spark.createDataFrame(ACCOUNTS, "name string, score int, balance int, credit_limit int, missed_payments int")
    got = {r.name: (r.utilization, r.risk_tier, r.urgent, r.decision) for r in risk.enrich_accounts(df).collect()}
    assert got["Alice"] == (0.75, "Medium", False, "Monitor")
    assert got["Dave"] == (0.96, "High", True, "Restrict credit")
    assert got["Grace"] == (0.125, "Low", False, "Approved for limit increase")
    assert got["Frank"] == (0.96, "Medium", True, "Monitor")


def test_fraud_scan(spark):
    scored = risk.score_transactions(spark.createDataFrame(TRANSACTIONS, TXN_SCHEMA))
    rows = {r.txn_id: (r.risk_score, r.action) for r in scored.collect()}
    assert rows[2] == (9.2, "Block")
    assert rows[3] == (5.5, "Review")
    assert rows[5] == (5.2, "Review")
    assert rows[6] == (0.34, "Allow")
    assert [r.customer for r in risk.suspicious_customers(scored).orderBy("customer").collect()] == ["Alice", "Bob"]
    report = risk.fraud_report(scored, "txn_id").first()
    assert (report.total_txns, report.n_block, report.n_review, report.n_allow) == (8, 3, 2, 3)
    assert (report.top_txn, report.top_score) == (4, 10.9) or report.top_score == 10.9


def test_payoff_matches_the_month_loop(spark):
    balance, months, trail = 5000.0, 0, []
    while balance > 0:
        balance = balance * (1 + 0.06 / 12) - 200
        months += 1
        trail.append(max(balance, 0))
    df = spark.createDataFrame([(1, 5000.0, 200.0), (2, 5000.0, 10.0)], "id int, b double, p double")
    rows = risk.payoff_schedule(df, "b", 0.06, "p").orderBy("month").collect()
    never = [r for r in rows if r.id == 2]  # the payment does not cover the interest
    assert [(r.month, r.n_months, r.remaining, r.status) for r in never] == [(None, None, None, "never")]
    rows = [r for r in rows if r.id == 1]
    assert len(rows) == months == 27
    assert [r.remaining for r in rows] == pytest.approx(trail, abs=1e-6)
    flat = spark.createDataFrame([(1, 5000.0, 500.0)], "id int, b double, p double")
    steps = risk.payoff_schedule(flat, "b", 0.0, "p").orderBy("month").collect()
    assert [r.remaining for r in steps] == [4500.0 - 500 * i for i in range(10)]
    assert spark.range(1).select(risk.periods_to_target(F.lit(1000.0), 0.05, F.lit(1500.0))).first()[0] == 9


def test_loss_trials(spark):
    df = spark.range(2000).select("id", F.lit(0.05).alias("pd"), F.lit(100.0).alias("ead"))
    losses = risk.loss_trials(df, "id", "pd", "ead", 200)
    row = risk.expected_loss_and_var(losses).first()
    assert row.n_trials == 200
    assert row.expected_loss == pytest.approx(2000 * 0.05 * 60, rel=0.03)
    assert row.var_95 > row.expected_loss
    again = risk.expected_loss_and_var(risk.loss_trials(df.repartition(11), "id", "pd", "ead", 200)).first()
    assert again.expected_loss == pytest.approx(row.expected_loss)
    sure = spark.range(10).select("id", F.lit(1.0).alias("pd"), F.lit(1.0).alias("ead"))
    assert [r.loss for r in risk.loss_trials(sure, "id", "pd", "ead", 4).collect()] == pytest.approx([6.0] * 4)


def test_models_fees_and_scores(spark):
    rows = [(1, "Savings Account", 5000.0, 0.0), (2, "Checking Account", 300.0, 0.0), (3, "Credit Card", 4500.0, 5000.0), (4, "Credit Card", 4800.0, 5000.0)]
    df = spark.createDataFrame(rows, "id int, kind string, balance double, credit_limit double")
    fees = {r.id: r.fee for r in df.select("id", risk.monthly_fee("kind", "balance", "credit_limit").alias("fee")).collect()}
    assert fees == {1: 0, 2: 5, 3: 0, 4: 15}
    models = {"balance": risk.balance_model("balance"), "utilization": risk.utilization_model("kind", "balance", "credit_limit")}
    matrix = {(r.id, r.model): r.score for r in risk.model_matrix(df, "id", models).collect()}
    assert matrix[(3, "balance")] == 55 and matrix[(3, "utilization")] == 90 and matrix[(1, "utilization")] == 0
    best = {r.id: r.model for r in risk.best_model(df, "id", models).collect()}
    assert best == {1: "balance", 2: "balance", 3: "utilization", 4: "utilization"}
    safe = spark.createDataFrame([(1, 2.0, None), (2, 2.0, 3.0)], "id int, a double, b double")
    got = [r[0] for r in safe.orderBy("id").select(risk.safe_score(["a", "b"], F.col("a") * F.col("b"))).collect()]
    assert got == [None, 6.0]


def test_payments(spark):
    df = spark.createDataFrame([("standard",), ("personal",), ("mortgage",)], "kind string")
    pay = risk.payment_by_product("kind", F.lit(10000.0), 0.05, F.lit(12))
    assert [round(r[0], 2) for r in df.select(pay).collect()] == [875.0, 877.08, 41.67]
    assert spark.range(1).select(risk.installment(F.lit(10000.0), F.lit(5), F.lit(24))).first()[0] == 437.5


def test_parameterised_rules(spark):
    df = spark.createDataFrame([(10,), (0,), (-3,)], "d int")
    assert [r[0] for r in df.select(risk.late_fee(5)(F.col("d"))).collect()] == [50, 0, 0]
    assert [r[0] for r in df.select(risk.velocity_check(5)(F.col("d"))).collect()] == ["BLOCK", "OK", "OK"]


# ------------------------------------------------------------------ sources and sinks
def test_loan_csv_types_and_blanks(spark, tmp_path):
    path = tmp_path / "loans.csv"
    path.write_text(
        "application_id,application_date,applicant_age,annual_income,credit_score,employment_status,home_ownership,"
        "num_dependents,existing_debt,loan_amount,loan_term_months,loan_status\n"
        '1,2024-02-05,33,,701.0,"Employed, full time",Rent,0,100.5,9000.0,36,Approved\n'
    )
    row = io.read_csv(spark, str(path), io.LOANS_SCHEMA).first()
    assert row.annual_income is None and row.employment_status == "Employed, full time"
    assert row.application_date.isoformat() == "2024-02-05"
    assert io.read_csv(spark, str(path), io.LOANS_SCHEMA, columns=["loan_status"]).columns == ["loan_status"]


def test_missing_path_is_empty(spark, tmp_path):
    df = io.read_or_empty(spark, str(tmp_path / "nowhere"), io.BUREAU_SCHEMA)
    assert df.count() == 0 and df.columns[0] == "application_id"


def test_appending_and_snapshot(spark, tmp_path):
    df = spark.range(5)
    io.write_csv(df, str(tmp_path / "out"))
    io.append_csv(df, str(tmp_path / "out"))
    assert io.read_csv(spark, str(tmp_path / "out"), "id long").count() == 10
    io.save_snapshot(df, str(tmp_path / "snap"))
    assert io.load_snapshot(spark, str(tmp_path / "snap"), ["id"]).count() == 5
    assert '\n' in io.to_json_rows(df.limit(1), pretty=True).first().json


def test_records(spark):
    rows = [{"name": "Alice", "income": 45000}, {"name": "Bob"}]
    got = records.from_records(spark, rows, "name string, income int").collect()
    assert [r.income for r in got] == [45000, None]
    cols = records.from_columns(spark, {"a": [1, 2], "b": ["x", "y"]}, "a int, b string")
    assert [tuple(r) for r in cols.collect()] == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        records.from_columns(spark, {"a": [1], "b": []}, "a int, b string")
    assert records.from_mapping(spark, {"A101": 1.0}, "k string, v double").first().v == 1.0


def test_memory_delimited(spark):
    df = spark.createDataFrame([("K7:41.5|K9:88",)], "log string")
    got = io.explode_delimited(df, "log", "|", ":", ["id", "amount"]).collect()
    assert [(r.entry_no, r.id, r.amount) for r in got] == [(0, "K7", "41.5"), (1, "K9", "88")]


def session_with(settings, master):
    """Just enough of a session: ``spark.checkpoint.dir`` cannot be changed on a running one."""
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)),
        sparkContext=SimpleNamespace(master=master, applicationId=uuid.uuid4().hex),
        _jvm=MagicMock(), _jsc=MagicMock(),
    )


def test_work_dir_follows_the_cluster_setting(tmp_path):
    shared = session_with({"spark.checkpoint.dir": str(tmp_path)}, "yarn")
    assert work_dir(shared, "x").startswith(str(tmp_path))
    assert work_dir(shared, "x") != work_dir(shared, "x")
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            work_dir(session_with({}, master), "x")
    assert work_dir(session_with({}, "yarn"), "x", base="/shared").startswith("/shared/x-")
    assert work_dir(session_with({}, "local[2]"), "x")


# ------------------------------------------------------------------ streams
@pytest.fixture
def arriving(spark, tmp_path):
    """Three files of one micro-batch each."""
    folder = tmp_path / "in"
    for i in range(3):
        part = spark.range(i * 4, i * 4 + 4).select(
            "id", (F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("ts"),
        )
        part.coalesce(1).write.mode("append").parquet(str(folder))
    return M.read_parquet_stream(spark, str(folder), "*.parquet", files_per_trigger=1)


def test_sequence_runs_across_batches(spark, arriving, tmp_path):
    got = M.flag_sequence(arriving, F.col("id") != 2, "k", ["ts", "id"], str(tmp_path / "seq")).collect()
    per_key = {}
    for r in sorted(got, key=lambda r: r.id):
        per_key.setdefault(r.k, []).append(r.seq)
    assert {k: sorted(v) for k, v in per_key.items()} == {0: [1, 2, 3, 4, 5], 1: [1, 2, 3, 4, 5, 6]}
    assert len(os.listdir(tmp_path / "seq" / "items")) == 3


def test_running_totals_and_batches(arriving):
    totals = {r.k: r.total for r in M.drain_state_table(M.running_totals(arriving, "k", "v"), ["k"]).collect()}
    assert totals == {0: 30.0, 1: 36.0}
    merged = M.reduce_batches(arriving, ["k"], {"n": (F.count(F.lit(1)), F.sum)})
    assert {r.k: r.n for r in merged.collect()} == {0: 6, 1: 6}


def test_streams_without_data_give_empty_results(spark, tmp_path):
    spark.range(1).select("id", F.col("id").alias("k"), F.lit(1.0).alias("v")).write.parquet(str(tmp_path / "shape"))
    empty = spark.readStream.schema("id long, k long, v double").parquet(str(tmp_path / "shape") + "/none*")
    assert M.drain_state_table(M.running_totals(empty, "k", "v"), ["k"]).count() == 0
    assert M.reduce_batches(empty, ["k"], {"n": (F.count(F.lit(1)), F.sum)}).count() == 0
    assert M.flag_sequence(empty, F.col("v") > 0, "k", ["id"], str(tmp_path / "s")).count() == 0


def test_stream_filter_and_dedupe(arriving):
    texts = arriving.withColumn("raw", F.when(F.col("id") % 3 == 0, "x").otherwise(F.col("id").cast("string")))
    assert M.drain_to_table(M.keep_parsable(texts, "raw")).count() == 8
    doubled = arriving.select("id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("c"))
    assert M.drain_to_table(M.dedupe(doubled, "id", "ts").select("id")).count() == 12


def test_windowed_volume(arriving):
    got = M.drain_state_table(M.windowed_volume(arriving, "ts", "v", "5 minutes"), ["window_start"]).orderBy("window_start").collect()
    assert [r.n for r in got] == [5, 5, 2]


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    batch = spark.createDataFrame(TRANSACTIONS, TXN_SCHEMA)
    batch.write.parquet(str(tmp_path / "txns"))
    stream = M.read_parquet_stream(spark, str(tmp_path / "txns"), "*.parquet")
    got = M.drain_to_table(M.fraud_monitor(stream)).orderBy("txn_id").collect()
    assert got == risk.score_transactions(batch).orderBy("txn_id").collect()
    summary = M.drain_state_table(M.fraud_summary(stream), ["customer"]).orderBy("customer").collect()
    assert summary == risk.customer_summary(risk.score_transactions(batch)).orderBy("customer").collect()
