"""Schemas of the manifests that stages exchange, as DDL."""

from __future__ import annotations

CHECKPOINT = "record_key string, source_id string, source_rank string, video_id string, audio_path string, status string, reason string"
SELECTION = "record_key string, source_id string, source_rank string, expected_title string, expected_artist string, expected_version string"
AUDIO = (
    "sample_id string, record_key string, source_id string, source_rank int, video_id string, expected_title string, expected_artist string, expected_version string, "
    "raw_path string, canonical_path string, preview_path string, download_status string, download_reason string, user_identity_override boolean, "
    "source_duration double, source_codec string, source_sample_rate int, source_channels int, duration double, sample_rate int, channels int, silence_ratio double, audio_valid boolean, reject_reason string"
)
CLASSIFIED = "vocal_status string, lyrics_prominence double, recommended_action string, reason string, classification_status string, classification_error string, classification_attempts int"
VOCAL = f"{AUDIO}, {CLASSIFIED}"
SEPARATION = "sample_id string, record_key string, preset string, source_path string, separated_path string, preview_path string, separation_status string, separation_error string, elapsed_seconds double, separated_at string, duration double, sample_rate int, channels int"
SEARCH = "sample_id string, section_start double, section_end double, search_status string, search_reason string"
MIR = "sample_id string, analysis_status string, bpm int, keyscale string, key_confidence double, timesignature string, beats array<double>, downbeats array<double>, beat_positions array<int>, sections array<struct<label:string,raw_label:string,start:double,end:double>>"
TRACKER = "best_loss double, best_epoch int, stale_checks int, latest_loss double"

#: Vocal status to the action it asks for, statuses of finished downloads, and what a reason says where a user decided on the identity.
ACTIONS = {"instrumental": "keep_original", "vocal_chops": "keep_original", "lyrics": "separate_vocals", "uncertain": "manual_check"}
DOWNLOADED = ("COMPLETE", "REUSED_DUPLICATE")
OVERRIDE = "user_override_identity:"
