"""recflow.sources."""
