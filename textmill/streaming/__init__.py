"""Row-local steps on a stream."""
