from kensa import api

SURVEY_NAMES = """read_images read_image_bytes read_labels filter_image_files filter_manifest ingest_files
prefer_source overwrite_table write_split list_tables list_catalogs select_training drop_columns
drop_datetime fill_zero take_split filter_runs prefix_filter non_blank verdict first_prediction
with_default_prediction check_name label_images with_line reports_for unmatched anomaly_share
anomaly_counts anomalies_by_line is_empty folder_is_empty any_folder_empty weighted_f1 score_timing
split_counts latest_run staleness top_passages transcript rank_lines sample_input number_turns
append_turns clear_history normalise_role setup_schema ensure_loaded wait_for_table run_stamp
parse_stamp to_day title_case content_key noise b64 data_uri prompt chat_request score_request
parse_predictions base_name swap_prefix flag round_ms margin_box square_box capture_error
category_codes to_rgb square_resize margin_crop resize_center_crop to_tensor normalise
training_tensors score_batches assign_split holdout sanitise fit_forest predict run_training
score_images stream_images stream_verdicts active_streams stop_streams await_streams""".split()


def test_every_survey_operator_is_exported():
    missing = [n for n in SURVEY_NAMES if not callable(getattr(api, n, None))]
    assert missing == []
