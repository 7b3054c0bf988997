"""Analytics operators."""
