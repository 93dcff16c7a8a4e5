"""DataFrame -> DataFrame operators, one module per stage of the rebuild."""

from . import arr, batch, facts, legacy, monthly, refunds, rollforward, staging

__all__ = ["arr", "batch", "facts", "legacy", "monthly", "refunds", "rollforward", "staging"]
