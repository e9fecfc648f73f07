from tripweave.sources.files import read_csv, read_declared, read_parquet
from tripweave.sources.kafka import kafka_batch, kafka_stream
from tripweave.sources.rows import append_rows, literal_rows

__all__ = [
    "append_rows", "kafka_batch", "kafka_stream", "literal_rows", "read_csv", "read_declared",
    "read_parquet",
]
