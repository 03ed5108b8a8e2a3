"""Training-data operators (de-duplication, counting, filtering, scanning, mixing, sharding).

Nothing outside this package imports it; ``queries.py`` registers the queries.
"""
