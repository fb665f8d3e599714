"""The job on an unbounded message stream."""
