"""Time the chosen plans against the literal form of the same definitions.

    BENCH_SF_DIR=... python bench_forms.py
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent / "tests"))

from compare import local_session
from literal_forms import (
    literal_grain,
    literal_metric_sections,
    literal_rfm,
    literal_row_flags,
)
from tillgrain.operators import calendar, rfm, rowflags, scorecard, snapshot
from tillgrain.plans.catalog import lakehouse
from tillgrain.sources.tables import materialise


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    house = lakehouse(spark, sf_dir)
    raw, rules = house.raw, house.rules
    filtered = materialise(spark, house.txn_filtered, "forms_filtered")
    dim = calendar.month_dimension(spark, rules)

    def grain_by_joins():
        return literal_grain(filtered, dim, snapshot.activity_months(filtered))

    forms = {
        "grain": (lambda: snapshot.composite_grain(filtered, rules), grain_by_joins),
        "rfm": (
            lambda: rfm.rfm_full_refresh(filtered, rules),
            lambda: literal_rfm(grain_by_joins(), filtered),
        ),
        "row_flags": (
            lambda: rowflags.row_level_flags(spark, raw, rules),
            lambda: literal_row_flags(raw, rules),
        ),
        "metrics": (
            lambda: scorecard.metric_rows(raw, rules),
            lambda: literal_metric_sections(raw, rules),
        ),
    }
    out: dict[str, float] = {}
    for _ in range(4):  # interleaved, so that both forms run on a warm JVM
        for name, pair in forms.items():
            for label, build in zip(("chosen", "literal"), pair, strict=True):
                started = time.perf_counter()
                build().write.format("noop").mode("overwrite").save()
                took = round(time.perf_counter() - started, 2)
                key = f"{name}_{label}"
                out[key] = min(out.get(key, took), took)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
