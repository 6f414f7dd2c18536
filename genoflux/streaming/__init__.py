"""Structured Streaming extension: specimens are assigned as they arrive.

Assignment is stateless per specimen, so a stream of specimens joins a frozen
consensus table; nothing here exists in batch form only for the stream.
"""
