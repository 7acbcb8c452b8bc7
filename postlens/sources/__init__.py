"""Scans, feed readers, artefact readers and sinks."""
