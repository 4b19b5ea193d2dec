from docflow.streaming.transfer import dedupe_stream, file_stream, run_to_parquet, stream_transfer

__all__ = ["dedupe_stream", "file_stream", "run_to_parquet", "stream_transfer"]
