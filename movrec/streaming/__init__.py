from movrec.streaming.requests import start_request_stream, write_batch

__all__ = ["start_request_stream", "write_batch"]
