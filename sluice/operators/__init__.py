"""Spark operators: each is a DataFrame -> DataFrame function."""

from sluice.operators.dedup import latest_per_key
from sluice.operators.merge import (merge_upsert, merge_counts, merge_message, current_rows,
                                    batch_rows, source_latest, empty_staging)
from sluice.operators.projection import (typed_projection, flag_bad_rows, split_bad_rows,
                                         convert, stamp_audit, lineage)
from sluice.operators.aggregate import ordered_concat, ordered_concat_chunks, column_list
from sluice.operators.watermark import watermark_current, watermark_lookup, next_watermark
from sluice.operators.runlog import (run_log_current, run_history, failed_since, run_trend,
                                     open_errors)
from sluice.operators.quality import (Rule, rules_from_table, evaluate_rules, dq_summary,
                                      quarantined, loadable, batch_verdict, domain_violations,
                                      not_null_violations, unique_violations, fk_violations,
                                      with_defaults, dq_results, dq_report)
from sluice.operators.drift import (row_count_check, profile, load_drift, evolve_schema,
                                   schema_changes)

__all__ = [n for n in dir() if not n.startswith("_")]
