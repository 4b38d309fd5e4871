"""recflow.streaming."""
