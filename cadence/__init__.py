"""cadence: Spark-native data work for continuously retrained tabular classifiers.

Every operator is a function ``op(df, ...) -> DataFrame``; stateful ones are a
``fit(df) -> params`` / ``apply(df, params)`` pair. Work runs on executors through the
DataFrame / SQL / ML / Structured Streaming APIs; the driver only ever sees bounded
results (one-row statistics, category lists under a checked cap, decision rows).
"""

from cadence.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
