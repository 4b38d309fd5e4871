"""recflow.plans."""
