from titlemart.streaming.insert import insert_stream, read_rejected

__all__ = ["insert_stream", "read_rejected"]
