"""cadence.operators."""
