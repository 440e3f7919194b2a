"""Structured Streaming operators."""

from cadence.streaming.streams import (canary_windows, file_stream, incremental_input, pair_streams, read_counters,
                                       read_gauges, read_histograms, rollout_state_machine, rollout_with_deadlines,
                                       run_available, stream_counters, stream_gauges, stream_histograms, stream_scores,
                                       table_stream)

__all__ = ["canary_windows", "file_stream", "incremental_input", "pair_streams", "read_counters", "read_gauges",
           "read_histograms", "rollout_state_machine", "rollout_with_deadlines", "run_available", "stream_counters",
           "stream_gauges", "stream_histograms", "stream_scores", "table_stream"]
