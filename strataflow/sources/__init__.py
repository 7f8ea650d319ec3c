"""Raw inputs as DataFrames with one text column ``value``, and reference tables."""

from strataflow.sources.readers import (  # noqa: F401
    csv_stream,
    jdbc_table,
    json_rows,
    kafka_text,
    text_files,
    topic_frames,
)
