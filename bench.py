"""Time the registered queries: each is planned, run in full and its rows discarded.

Prints one JSON line.  BENCH_SF_DIR and BENCH_CPUS choose data and cores;
BENCH_QUERIES (comma-separated) narrows the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideline.session import build_session  # noqa: E402
from tideline.suite import QUERIES  # noqa: E402

HEADLINE = (
    "orders_arrived null_tokens csv_lenient csv_rejects fixed_width_roundtrip dbf_roundtrip typed_scan_stringify multi_source_union "
    "uneven_csv_union file_stream_ingest sql_alias_report sql_multi_alias_union sanitize_headers datetime_detect datetime_normalize "
    "trim_strings_all replace_regex cast_lenient null_fill null_drop nested_to_string homogenize_records dedupe_all dedupe_subset "
    "transform_chain convert_values parse_dates_any good_rows_loaded width_profiles type_profiles conversion_counts pk_check fk_check "
    "declared_constraints row_count_by_file sample_by_hash sample_of_copies content_accuracy content_mismatches best_match "
    "column_discrepancy quality_history export_csv row_ids table_run tables_summary tables_report file_batches_ingest rejected_rows_kept"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
