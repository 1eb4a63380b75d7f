"""Per-file helpers run inside Spark tasks (and in the stream reader's planner).

They touch a bounded window of bytes per call: a file head for the checksum,
a few blocks around a planned end for newline alignment, or one chunk of a
range for line splitting.
"""
