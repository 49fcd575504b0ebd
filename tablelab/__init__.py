"""tablelab: Spark DataFrame operators for skew, data quality, drift, versioned
snapshots, late and duplicate stream data, and event-log analytics."""

import sys as _sys

__version__ = "0.1.0"

# Functions that run in Python workers (mapInPandas, pandas UDFs) are pickled by
# value, so executors need no installed copy of this package.  A cluster may still
# ship it with --py-files; both work.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the API
    pass

# The public operators, importable from the package root.
from tablelab.operators.expect import assert_all, expect, summarize  # noqa: E402,F401
from tablelab.operators.infer import infer_types  # noqa: E402,F401
from tablelab.operators.keyed import keyed_changes, write_version  # noqa: E402,F401
from tablelab.operators.profile import (  # noqa: E402,F401
    approx_profile,
    global_profile,
    key_frequency,
    ordered_top,
    skew_ratio,
    topk_per_key,
)
from tablelab.operators.quality import (  # noqa: E402,F401
    parse_csv,
    parse_json,
    reconcile,
    schema_drift,
    summarize_bad,
    summarize_tagged,
    tag_csv,
    tag_json,
)
from tablelab.operators.sketches import figures, frequent_keys, merge_profiles, profile_parts  # noqa: E402,F401
from tablelab.operators.skew import (  # noqa: E402,F401
    Agg,
    file_layout,
    hot_key_join,
    partition_balance,
    preagg_join,
    salted_agg,
    salted_join,
)
from tablelab.operators.snapshots import Snapshots  # noqa: E402,F401
from tablelab.operators.udf import map_catching, map_vectorized  # noqa: E402,F401
from tablelab.sources.csv_records import read_csv_records  # noqa: E402,F401
from tablelab.sources.eventlog import read_task_metrics, task_metrics  # noqa: E402,F401
from tablelab.sources.parquet_audit import audit_parquet, read_healthy  # noqa: E402,F401
from tablelab.sources.zone_map import check_zones, zone_map, zone_overlap  # noqa: E402,F401
from tablelab.streaming.late import mark_late  # noqa: E402,F401
from tablelab.streaming.runner import run_available, stream_session  # noqa: E402,F401
from tablelab.streaming.state import open_sessions, open_windows, read_state  # noqa: E402,F401
from tablelab.streaming.windows import dedup, late_report, sessions, windowed  # noqa: E402,F401
