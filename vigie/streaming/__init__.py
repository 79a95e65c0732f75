"""Incremental (micro-batch) form of the detection load.

The studied workload has no streams: its only repeated execution is the per-(territory, batch) load loop, where each
committed batch is visible to the next one's first-detection test. Here that loop is expressed as Structured
Streaming micro-batches: every batch of newly inferred detections is flagged against the table already written
(``first_detection_increment``) and appended, so re-running one batch is the only ordering dependency.
"""

from vigie.streaming.incremental import append_batch, first_detection_increment, start_incremental_load

__all__ = ["append_batch", "first_detection_increment", "start_incremental_load"]
