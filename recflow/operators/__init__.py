"""recflow.operators."""
