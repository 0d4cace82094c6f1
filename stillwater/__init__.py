"""Quality control of sensor time series on Spark: DataFrame in, DataFrame out."""
from .functions.flags import add_flag, ensure_column, fold_flags
from .functions.timegrid import parse_any, round_time
from .operators.finish import dashboard_columns, drop_lone_suspect, final_projection, suspect_flag, tidy_flags
from .operators.malfunction import malfunction_flag
from .operators.merge import merge_archive, merge_preflag, overlap_changes, recent, trailing_history
from .operators.network import network_check, network_edges
from .operators.notes import attach_field_notes, clean_notes, cleaning_notes, malfunction_notes, newest_first, sensor_notes
from .operators.prepare import (
    clean_readings, interval_summary, mask_omitted, pad_grid, prepare_series, series_bounds, standardize_site_names,
    standardize_turbidity, with_join_stamp,
)
from .operators.series_rules import (
    depth_shift, do_noise_flags, drift_flag, field_flags, missing_flag, repeat_flag, seasonal_flag, spec_flag,
)
from .operators.signal import interpolate_gaps, low_pass, spacing_report
from .operators.site_rules import frozen_flag, reconcile_slope, spread_burial, unsubmerged_flag
from .operators.statistics import summary_statistics
from .operators.telemetry import clean_locations, flatten_pages, located_readings, match_locations, name_tables, reading_names
from .operators.thresholds import exact_quantiles, threshold_table
from .operators.tracking import reading_counts, retention, session_dates, tracker_update
from .plans.asof import time_bounds
from .plans.incremental import commit_batch, incremental_run, next_session
from .plans.layout import Layout, number_rows
from .plans.pipeline import curated, flag_merged, run_pipeline
from .session import local_session, use_utc
from .sources.archive import (
    Commit, Conflict, clear_unused, commit_table, read_archive, read_commit, series_index, trailing_rows, write_back,
)
from .sources.ordered import read_first, with_position, write_ordered
from .sources.readers import (
    literal_table, load_networks, normal_networks, read_field_notes, read_latest, read_locations, read_names, read_pages, read_raw,
    read_sensor_spec, read_thresholds, snapshot_stamp,
)
from .sources.writers import archive_append, new_to_archive, with_source_file, write_raw, write_series_csv, write_snapshot
from .streaming.jobs import archive_batch, late_rows, open_windows, read_raw_stream, stream_interval_summary, stream_pipeline, stream_to_archive
from .streaming.late import closed_summary, forget as forget_rows, late_readings, open_summary, stream_summary, summary_batch
