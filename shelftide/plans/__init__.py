"""Named queries, their SQL counterparts and the full run."""
