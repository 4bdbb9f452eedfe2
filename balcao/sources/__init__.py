"""Scans and sinks: raw envelopes, lake tables, reference files, sample star."""
