from tickshard.streaming.sink import write_stream

__all__ = ["write_stream"]
