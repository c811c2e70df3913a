"""Composed models (the reference's marts) and the driver-table queries."""
