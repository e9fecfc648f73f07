from tripweave.sinks.files import store, write_bucketed, write_by_day, write_parquet
from tripweave.sinks.messages import (
    json_messages, keyed_json_messages, write_kafka, write_message_files,
)
from tripweave.sinks.summaries import mark_batch, read_committed, write_batch

__all__ = [
    "json_messages", "keyed_json_messages", "mark_batch", "read_committed", "store", "write_batch", "write_bucketed", "write_by_day", "write_kafka",
    "write_message_files", "write_parquet",
]
