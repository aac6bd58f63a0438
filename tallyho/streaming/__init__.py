from tallyho.streaming.rerun import rerun_batch, start_rerun_stream

__all__ = ["rerun_batch", "start_rerun_stream"]
