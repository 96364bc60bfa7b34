"""Risk jobs: account scan, fraud scoring, standardised score, loss distribution, amortisation.

The row rules are Column functions, so the same code serves batch tables and streams.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.numbers import linear_score, round_half_even
from riskframe.functions.recode import first_match, lookup
from riskframe.operators.profile import draw_below, draw_key, draw_threshold, spread
from riskframe.operators.stats import z_scores

# Tier cuts, default probabilities, score weights, loss given default.
SCORE_TIERS = [(750, "Low"), (650, "Medium")]
PD_BY_TIER = {"Low": 0.01, "Medium": 0.05, "High": 0.15, "Very High": 0.35}
RISK_WEIGHTS = (-0.4, 0.3, 0.2, -0.1)
LOSS_GIVEN_DEFAULT = 0.6


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ account scan
def score_tier(score) -> Column:
    return first_match([(_c(score) >= cut, label) for cut, label in SCORE_TIERS], "High")


def four_tier(score) -> Column:
    """Low from 740, Medium from 670, High from 580, else Very High."""
    s = _c(score)
    return first_match([(s >= 740, "Low"), (s >= 670, "Medium"), (s >= 580, "High")], "Very High")


def enrich_accounts(df: DataFrame, score="score", balance="balance", limit="credit_limit", missed="missed_payments") -> DataFrame:
    """Utilization, tier, urgent flag and credit decision per account, in one projection chain."""
    out = df.withColumns(
        {
            "utilization": round_half_even(F.try_divide(_c(balance), _c(limit)), 3),
            "risk_tier": score_tier(score),
        }
    )
    return out.withColumns(
        {
            "urgent": F.coalesce((_c(missed) >= 2) | (F.col("utilization") > 0.9), F.lit(False)),
            "decision": first_match(
                [
                    (_c(missed) >= 3, "Restrict credit"),
                    (F.col("utilization") > 0.85, "Monitor"),
                    (
                        (F.col("risk_tier") == "Low") & (F.col("utilization") < 0.5),
                        "Approved for limit increase",
                    ),
                ],
                "Monitor",
            ),
        }
    )


# ------------------------------------------------------------------ fraud
def fraud_score(amount, is_foreign, is_night) -> Column:
    """Amount in thousands, plus 2 for foreign and 1 for night transactions."""
    raw = (
        _c(amount) / F.lit(1000.0)
        + F.when(_c(is_foreign), 2).otherwise(0)
        + F.when(_c(is_night), 1).otherwise(0)
    )
    return round_half_even(raw, 2)


def fraud_action(score, amount, is_foreign) -> Column:
    return first_match(
        [
            (_c(score) > 8, "Block"),
            (_c(score) > 5, "Review"),
            (_c(is_foreign) & (_c(amount) > 1000), "Verify"),
        ],
        "Allow",
    )


def score_transactions(df: DataFrame) -> DataFrame:
    """Add ``risk_score``, ``flagged`` and ``action`` to (amount, is_foreign, is_night) rows."""
    scored = df.withColumn("risk_score", fraud_score("amount", "is_foreign", "is_night"))
    return scored.withColumns(
        {
            "flagged": F.col("risk_score") > 5,
            "action": fraud_action("risk_score", "amount", "is_foreign"),
        }
    )


def customer_summary(scored: DataFrame, customer: str = "customer") -> DataFrame:
    return scored.groupBy(customer).agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_amount"),
        F.max("risk_score").alias("max_risk_score"), F.count_if("flagged").alias("n_flagged"),
    )


def suspicious_customers(scored: DataFrame, customer: str = "customer", min_txns: int = 3) -> DataFrame:
    """Busy customers with a flagged transaction; the flag count rides on the same aggregate."""
    return customer_summary(scored, customer).filter(
        (F.col("txn_count") >= min_txns) & (F.col("n_flagged") > 0)
    )


def fraud_report(scored: DataFrame, key: str) -> DataFrame:
    """One row: totals, count per action, amount not allowed, riskiest transaction."""
    top = F.max_by(F.struct(key, "risk_score"), F.struct(F.col("risk_score"), -F.col(key)))
    actions = ("Block", "Review", "Verify", "Allow")
    return scored.agg(
        F.count(F.lit(1)).alias("total_txns"),
        *[F.count_if(F.col("action") == a).alias(f"n_{a.lower()}") for a in actions],
        F.sum(F.when(F.col("action") != "Allow", F.col("amount")).otherwise(0.0)).alias("flagged_amount"),
        top.alias("t"),
    ).select("*", F.col(f"t.{key}").alias("top_txn"), F.col("t.risk_score").alias("top_score")).drop("t")


# ------------------------------------------------------------------ standardised score
def standardized_score(df: DataFrame, features: Sequence[str], weights: Sequence[float] = RISK_WEIGHTS, name: str = "risk_score") -> DataFrame:
    """Population z-scores combined with fixed weights."""
    z = z_scores(df, features, population=True, suffix="__z")
    total = linear_score([(F.col(f"{c}__z"), w) for c, w in zip(features, weights)])
    return z.withColumn(name, total).drop(*[f"{c}__z" for c in features])


def default_probability(tier) -> Column:
    return lookup(tier, PD_BY_TIER)


# ------------------------------------------------------------------ loss distribution
def loss_trials(df: DataFrame, key: str, pd_col: str, exposure: str, trials: int, seed: int = 99, lgd: float = LOSS_GIVEN_DEFAULT) -> DataFrame:
    """Portfolio loss per trial: sum of exposure x LGD over accounts that default in the trial.

    The draw for (account, trial) is a 32-bit slice of one MD5 over the account and a block of four
    trials, so it does not depend on partitioning and can be repeated in any SQL engine. Rows are
    expanded inside their task and summed map-side; the shuffle carries one row per trial and task.
    """
    if trials % 4:
        raise ValueError("trials must be a multiple of 4 (one hash serves four draws)")
    at_risk = df.select(key, (F.col(exposure) * F.lit(lgd)).alias("__hit"), draw_threshold(F.col(pd_col)).alias("__t"))
    blocks = spread(at_risk, key).withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(trials // 4 - 1))))
    digest = blocks.withColumn("__h", draw_key(seed, key, "__block"))
    # the four draws of a block are four conditional sums, so rows grow with blocks, not trials
    sums = digest.groupBy("__block").agg(
        *[
            F.sum(F.when(draw_below(F.col("__h"), F.col("__t"), i), F.col("__hit")).otherwise(0.0)).alias(f"l{i}")
            for i in range(4)
        ]
    )
    losses = F.array(
        *[F.struct((F.col("__block") * 4 + i).alias("trial"), F.col(f"l{i}").alias("loss")) for i in range(4)]
    )
    return sums.select(F.inline(losses))


def expected_loss_and_var(losses: DataFrame, level: float = 0.95) -> DataFrame:
    """One row: mean loss and the ``level`` quantile over trials.

    One aggregate, so the simulation runs once; the quantile buffer holds one number per trial.
    """
    return losses.agg(
        F.count(F.lit(1)).alias("n_trials"), F.avg("loss").alias("expected_loss"),
        F.percentile("loss", F.lit(level)).alias("var_95"),
    )


# ------------------------------------------------------------------ amortisation
def months_to_payoff(balance, annual_rate: float, payment) -> Column:
    """Months until a constant payment clears the balance; null if it never does."""
    r = annual_rate / 12
    if r == 0:
        n = F.when(_c(payment) > 0, F.ceil(F.round(_c(balance) / _c(payment), 9)))
        return F.greatest(n, F.lit(0)).cast("int")
    inner = F.lit(1.0) - F.lit(r) * _c(balance) / _c(payment)
    n = F.ceil(F.round(-F.ln(inner) / F.lit(math.log1p(r)), 9))
    return F.when(inner > 0, F.greatest(n, F.lit(0))).cast("int")


def balance_after(balance, annual_rate: float, payment, months) -> Column:
    """Closed form of n months of interest and payment, not below zero."""
    r = annual_rate / 12
    if r == 0:
        return F.greatest(_c(balance) - _c(payment) * _c(months), F.lit(0.0))
    growth = F.pow(F.lit(1.0 + r), _c(months).cast("double"))
    left = _c(balance) * growth - _c(payment) * (growth - 1) / F.lit(r)
    return F.greatest(left, F.lit(0.0))


def payoff_schedule(df: DataFrame, balance: str, annual_rate: float, payment: str) -> DataFrame:
    """One row per account and month, computed without stepping through the months.

    ``status`` is ``paying``, ``settled`` (nothing is owed) or ``never`` (the payment does not cover
    the interest); accounts of the last two keep one row without a month.
    """
    n = months_to_payoff(balance, annual_rate, payment)
    status = F.when(F.col("n_months").isNull(), "never").when(F.col("n_months") > 0, "paying").otherwise("settled")
    steps = F.when(F.col("n_months") > 0, F.sequence(F.lit(1), F.greatest("n_months", F.lit(1))))
    months = df.withColumn("n_months", n).withColumn("status", status).withColumn("month", F.explode_outer(steps))
    left = balance_after(balance, annual_rate, payment, "month")
    return months.withColumn("remaining", F.when(F.col("month").isNotNull(), left))


def periods_to_target(start, rate: float, target) -> Column:
    """Periods of compound growth until the amount exceeds the target."""
    raw = F.ln(_c(target) / _c(start)) / F.lit(math.log1p(rate))
    return F.greatest(F.floor(F.round(raw, 9)) + 1, F.lit(0)).cast("int")


def installment(principal, rate_pct, months) -> Column:
    """Principal plus one flat interest charge, spread over the months."""
    return (_c(principal) + _c(principal) * _c(rate_pct) / F.lit(100.0)) / _c(months)


def payment_by_product(product, principal, rate: float, months) -> Column:
    """Flat-interest payment; personal loans add a fee of 25, mortgages pay interest only."""
    p, m = _c(principal), _c(months)
    flat = p * F.lit(1 + rate) / m
    return (
        F.when(_c(product) == "personal", flat + F.lit(25.0) / m)
        .when(_c(product) == "mortgage", p * F.lit(rate) / m)
        .otherwise(flat)
    )


# ------------------------------------------------------------------ model matrix
def balance_model(balance) -> Column:
    return F.greatest(F.lit(0.0), F.lit(100.0) - _c(balance) / F.lit(100.0))


def utilization_model(kind, balance, limit) -> Column:
    """Utilization in percent for credit cards, zero for other account types."""
    return F.when(_c(kind) == "Credit Card", F.try_divide(_c(balance), _c(limit)) * 100).otherwise(0.0)


def model_matrix(df: DataFrame, key: str, models: dict[str, Column]) -> DataFrame:
    """One row per account and model."""
    return df.select(key, *[c.alias(n) for n, c in models.items()]).unpivot(
        [key], list(models), "model", "score"
    )


def best_model(df: DataFrame, key: str, models: dict[str, Column]) -> DataFrame:
    """Highest-scoring model per account: a row-wise comparison, no shuffle.

    Ties go to the first model listed; missing scores do not compete.
    """
    best = F.greatest(*models.values())
    name = first_match([(c == best, n) for n, c in models.items()])
    return df.select(key, name.alias("model"), best.alias("score"))


def weighted_model(score, income) -> Column:
    """0.7 x score plus 0.3 x income in thousands."""
    return _c(score) * F.lit(0.7) + _c(income) / F.lit(1000.0) * F.lit(0.3)


def safe_score(required: Sequence[str], score: Column) -> Column:
    """Score only when every required field is present."""
    cond = F.col(required[0]).isNotNull()
    for c in required[1:]:
        cond = cond & F.col(c).isNotNull()
    return F.when(cond, score)


# ------------------------------------------------------------------ parameterised rules
def late_fee(daily_rate: float) -> Callable[[Column], Column]:
    """Fee rule for a daily rate: nothing when on time."""
    return lambda days: F.when(days <= 0, F.lit(0.0)).otherwise(days * F.lit(float(daily_rate)))


def velocity_check(max_transactions: int) -> Callable[[Column], Column]:
    return lambda count: F.when(count > max_transactions, "BLOCK").otherwise("OK")


def monthly_fee(kind, balance, limit) -> Column:
    """Checking accounts below 500 pay 5, credit cards above 90 % utilization pay 15."""
    k, b = _c(kind), _c(balance)
    return (
        F.when((k == "Checking Account") & (b < 500), 5)
        .when((k == "Credit Card") & (F.try_divide(b, _c(limit)) > 0.9), 15)
        .otherwise(0)
    )
