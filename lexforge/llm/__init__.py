"""Training-data operators: one module per operator, `catalog.py` registers their queries."""
