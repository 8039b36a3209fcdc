from snapflow.streaming.incremental import merge_batch, replay_incrementally, start_incremental

__all__ = ["merge_batch", "replay_incrementally", "start_incremental"]
