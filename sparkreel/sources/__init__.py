"""Readers and writers: annotations, records, frame files, checkpoints."""
