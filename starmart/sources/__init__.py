"""Readers, landing steps and report sinks."""
