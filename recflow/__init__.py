"""recflow: a Spark-native engine for routing and enriching recording transcripts.

Every operator takes and returns DataFrames (or Columns); the heavy work is
Catalyst/Tungsten expressions, joins, aggregations and Structured Streaming.
"""

from recflow.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
