"""Streaming form of the incremental load (micro-batch upserts)."""
