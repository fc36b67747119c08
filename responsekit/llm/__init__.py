"""Training-data pipeline operators.

Each module holds one operator with its own general interface and, at its
end, the registered query built on it (``queries.py`` gathers them).
"""
