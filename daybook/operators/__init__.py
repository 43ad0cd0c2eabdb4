"""Quality checks (B), silver (C), gold analytics (D) and dashboard marts (E)."""

from daybook.operators import gold, marts, quality, silver

__all__ = ["gold", "marts", "quality", "silver"]
