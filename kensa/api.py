"""

    from kensa import api
    api.anomalies_by_line(inspections, production)
"""

from __future__ import annotations

from kensa.functions.errors import capture_error  # C20
from kensa.functions.payloads import (  # C8-C13, P10
    answer_or_error, answer_text, b64, chat_request, data_uri, first_prediction, mime_of, parse_predictions,
    prompt, score_request, user_message)
from kensa.functions.scalar import (  # C1-C7, C14-C19
    base_name, content_key, flag, margin_box, noise, parse_stamp, round_ms, run_stamp, square_box,
    swap_prefix, title_case, to_day)
from kensa.operators.anomalies import (  # P9, J2, A1-A3, T5
    anomalies_by_line, anomaly_counts, anomaly_share, rank_lines, verdict, with_line)
from kensa.operators.encoding import category_codes  # C21
from kensa.operators.filters import (  # P1-P8, P11, P12, S4, S5
    check_name, check_names, drop_columns, drop_datetime, fill_zero, filter_image_files,
    filter_manifest, non_blank, prefix_filter, select_training, take_split, with_default_prediction)
from kensa.operators.history import (  # U1-U3, T4, T6, T7
    append_turns, clear_history, next_turns, normalise_role, number_turns, sample_input, transcript)
from kensa.operators.images import (  # I1-I8
    encode_png, image_vector, margin_crop, normalise, resize_center_crop, score_batches, square_resize,
    to_rgb, to_tensor, training_tensors)
from kensa.operators.joins import label_images, prefer_source, reports_for, unmatched  # J1, J3, J4, S7
from kensa.operators.metrics import is_empty, split_counts, weighted_f1  # A4, A6, A8
from kensa.operators.ml import (  # M3-M7, A7
    fit_forest, load_model, predict, run_training, run_trials, sanitise, save_model, score_images,
    score_images_with, score_timing)
from kensa.operators.retrieval import top_passages, top_vectors  # T3
from kensa.operators.runs import filter_runs, latest_run, staleness  # P6, T1, T2
from kensa.operators.splits import assign_split, holdout  # M1, M2
from kensa.sources.catalog import (  # S8-S12, U4-U6
    ensure_loaded, list_catalogs, list_tables, overwrite_table, read_table, setup_schema,
    wait_for_table, write_split)
from kensa.sources.files import (  # S1-S3, S6, A5
    any_folder_empty, file_counts, folder_is_empty, ingest_files, quarantine_labels, read_image_bytes,
    read_images, read_keyed_images, read_labels, relative_key)
from kensa.sources.sink import write_files  # S1, S2, S6
from kensa.streaming.streams import (  # X1-X5
    active_streams, await_streams, drain, run_until_batch, score_stream, score_stream_with, stop_streams,
    stream_images, stream_verdicts)

__all__ = [n for n in dir() if not n.startswith("_") and n != "annotations"]
