"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A query's time covers building its plan (including any eager sampling job), running it, and
producing every output row (``noop`` sink). One warm-up run, then the median of $BENCH_RUNS.
``python bench.py name ...`` times the named queries instead.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskframe.catalog import QUERIES, Tables
from riskframe.session import get_session

HEADLINE = """
scan_json prof_describe prof_describe_group prof_value_counts key_is_unique
proj_ratio proj_reset_pos filt_isin filt_step cond_select bin_digitize bin_hist_fixed
miss_per_col fill_median fill_group_median fill_ffill dup_flag dup_keep_last valid_rows_split
join_inner join_indicator join_pruned join_position cross_pairs cross_broadcast_row set_at_least_k set_split_folds
agg_global agg_named agg_region_summary agg_collect agg_percentile agg_error_ci agg_period
piv_margins xtab_row_pct resh_fold win_cumsum win_diff win_ecdf win_streak topk_largest sort_multi
str_char_count re_extract_entities dt_days_late arr_dot map_flatten
stat_corr_matrix stat_corr_spearman stat_linfit stat_polyfit2 stat_box stat_kde
risk_enrich risk_fraud risk_standardize_score risk_loss_trials risk_el_var risk_amortize risk_model_matrix
stream_fraud_monitor udf_group
""".split()


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, sf_dir)
    times = {}
    for name in names or HEADLINE:
        seen = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name].run(tables).write.format("noop").mode("overwrite").save()
            seen.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seen[1:]), 4)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians", "value": round(sum(times.values()), 3),
                "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus), "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
