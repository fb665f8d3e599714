"""The composed job, and the queries registered for checking it."""
