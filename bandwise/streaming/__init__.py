"""Structured Streaming entry points.

The original module has no streaming code. Its feature encoders and two-stage
scoring are stateless column work, so they run unchanged on a streaming
DataFrame; this package wires them to a file stream with a checkpoint in the
shared folder.
"""
