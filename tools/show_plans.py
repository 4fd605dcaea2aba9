"""Print the physical plans of the headline operators at a scale factor.

    python tools/show_plans.py [/root/testdata/sf0.1] [--no-broadcast]

``--no-broadcast`` turns off size-based broadcast so joins plan as they
would once the dimension tables outgrow the limit.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    from tablekit.session import build_session
    spark = build_session("local[8]", 16)
    if "--no-broadcast" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    from tablekit.operators.splits import group_rank
    from tablekit.plans import trips as TR
    from tablekit.plans.series import counter_samples
    from tablekit.operators import series as TS
    ev = spark.read.parquet(f"{sf}/events.parquet")
    plans = {
        "trip_cleanse (Z1)": TR.trip_output(TR.trip_frames(spark, sf)["final"]),
        "group_rank per user (exact rank, skew-safe)":
            group_rank(ev, ["ts", "event_id"], group=["user_id"], name="r", materialize=False),
        "counter_rate (W6, sliding frames by series x bucket)":
            TS.counter_rate(counter_samples(spark, sf), ["user_id", "event_type"], "ts", "value",
                            6 * 3600, 3600),
    }
    for name, df in plans.items():
        print(f"\n===== {name}")
        df.explain()


if __name__ == "__main__":
    main()
