"""Record types and closed vocabularies.

Two long tables carry a corpus: ``calls`` (one row a call) and ``turns`` (one row a turn; ``idx`` orders the turns of a call).
"""

from __future__ import annotations

# Issue and reason codes, in the order in which stages report them.
MODEL_TURN_ISSUES = ("improper_diarization", "incorrect_speaker_assignment", "garbled_transcript")
TIMING_ISSUES = ("too_short", "too_long")
TURN_ISSUES = MODEL_TURN_ISSUES + TIMING_ISSUES
FILE_ISSUES = ("incorrect_speaker_count", "nonsensical_conversation", "language_mismatch")
GATE_REASONS = ("language_not_allowed", "mono_speaker")
REJECT_REASONS = FILE_ISSUES + GATE_REASONS + ("low_confidence",)
AUDIO_ISSUES = ("mostly_silence", "low_energy", "tail_decay")
# Suffixes of audio files that a scan accepts.
AUDIO_SUFFIXES = ("m4a", "mp3", "wav", "flac", "ogg", "aac", "wma", "opus", "3gp")
# Limits in seconds, decibels and shares.
MIN_TURN, MAX_TURN, MERGE_GAP = 0.5, 60.0, 0.5
KEEP_MIN, KEEP_MAX = 3.0, 45.0
MIN_CONFIDENCE = 0.60
SILENCE_DB, LOW_ENERGY_DB, SPEECH_FLOOR_DB, MAX_DECAY_DB = -40.0, -30.0, -30.0, 5.0
MIN_SIMILARITY, MIN_MARGIN = 0.70, 0.15
SCRUB_BATCH, VALIDATION_BATCH, CONTEXT_TURNS, PARSE_RETRIES = 20, 80, 10, 2

TURN = "struct<speaker:string,start:double,end:double,text:string>"
CALL_DOCUMENT = f"call_id string, mode string, language string, num_speakers int, turns array<{TURN}>"
ASSIGNMENT = "struct<index:int,speaker:string,name:string,reasoning:string,issues:array<string>>"
VALIDATION_RESPONSE = f"struct<confidence:double,issues:array<string>,assignments:array<{ASSIGNMENT}>>"
CLOUD_RESULT = (
    "results struct<items:array<struct<type:string,start_time:string,end_time:string,alternatives:array<struct<content:string>>>>,"
    "speaker_labels:struct<segments:array<struct<speaker_label:string,items:array<struct<start_time:string>>>>>>"
)
MANIFEST = "audio string, text string, duration double"
