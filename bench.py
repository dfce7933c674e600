"""Time the registered queries; prints one JSON line.

Every query runs once untimed, then once timed, written in full to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from courtflow.plans.queries import registry
from courtflow.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "game_minutes",
    "lineups",
    "lineup_sets",
    "sub_index",
    "sub_durations",
    "bookends",
    "sort_plays",
    "latest_documents",
    "cull_payload",
    "html_to_payload",
    "complete_records",
    "discovered_keys",
    "pending_documents",
    "keys_to_fetch",
    "discover_games",
    "discover_players",
    "rep_dates",
    "schedule_games",
    "schedule_teams",
    "standings_alignments",
    "game_plays",
    "game_player_box",
    "player_updates",
    "insert_ignore",
    "fill_update",
    "upsert",
    "constraint_check",
    "write_batch",
    "ingest_stream_documents",
    "transform_counts",
)


def main(names: list[str]) -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS))
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()

    def run(name: str) -> float:
        begin = time.perf_counter()
        df = queries[name][0](spark, SF_DIR)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or list(HEADLINE))
