"""Checkpointed, wave-by-wave generation as a Structured Streaming query.

The reference has no streams; this package re-expresses its durable,
resumable append (write each result as it comes, resume after a stop) with
a file source, ``foreachBatch`` and a checkpoint. No windows or watermarks
are involved because the work has no event time.
"""

from dialforge.streaming.waves import generate_stream, read_wave_results, write_plan_files  # noqa: F401
