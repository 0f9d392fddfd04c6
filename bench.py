"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from contract.queries import REGISTERED
from teamlines.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "load_team_games", "rolling_mean", "rolling_std", "form_decay", "efficiency_trend", "schedule_strength",
    "team_features", "situational", "matchup", "all_features", "add_features", "build_features",
    "opponent_join_date", "game_level", "prepare_data", "time_folds", "stratified_split", "game_metrics",
    "threshold_scan", "roi_two_level", "season_backtest", "cv_summary", "format_predictions",
    "gbt_regression", "rf_backtest", "walk_forward",
]
SETTINGS = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.driver.memory"]


def main():
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8, name="bench")

    def run(name):
        start = time.time()
        REGISTERED[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        return round(time.time() - start, 3)

    run("team_features")  # start-up and compilation are not part of the numbers
    seconds = {name: run(name) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "settings": {k: spark.conf.get(k) for k in SETTINGS},
                "state": "one warm-up query, then each query once",
            }
        )
    )


if __name__ == "__main__":
    main()
