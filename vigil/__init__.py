"""vigil: payment-fraud analytics expressed as Spark DataFrame plans.

The same column expressions score a static lake replay and a Structured
Streaming micro-batch; marts, quality checks and dashboard queries are plain
functions from DataFrame to DataFrame, so Catalyst sees one plan end to end.
"""

from vigil.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
