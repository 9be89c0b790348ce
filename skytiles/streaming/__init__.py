from .partition import read_stream_output, start_partition_stream

__all__ = ["read_stream_output", "start_partition_stream"]
