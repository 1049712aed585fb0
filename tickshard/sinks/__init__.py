from tickshard.sinks.writer import PendingWrite, write_dataframe

__all__ = ["PendingWrite", "write_dataframe"]
