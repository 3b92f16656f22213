"""Records as a stream."""
