from tripweave.streaming.messages import decode_messages, text_stream
from tripweave.streaming.runner import run_batches, wait
from tripweave.streaming.scoring import score_messages, start_scoring
from tripweave.streaming.summaries import (
    category_counts, category_lists, numeric_summary, start_summaries,
)
from tripweave.streaming.windows import current_windows, late_rows, start_windowed_summary, windowed_summary

__all__ = [
    "category_counts", "category_lists", "current_windows", "decode_messages", "late_rows", "numeric_summary", "run_batches",
    "score_messages", "start_scoring", "start_summaries", "start_windowed_summary", "text_stream", "wait",
    "windowed_summary",
]
