"""Tables and streams read and written by the jobs."""
