"""I8: the streaming form of landing + dedup + upsert (an extension; the
batch incremental models are the primary path)."""
