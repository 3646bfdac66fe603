"""Structured Streaming forms of the operators (checked equal to the batch forms)."""
