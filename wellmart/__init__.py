"""wellmart: well-completion ETL jobs and their reusable DataFrame operators.

Layout
  functions/   column-level helpers: comparison semantics, rule tables
  operators/   DataFrame-level operators: latest record, ranks, lists, joins, set ops
  sources/     typed scans and full-refresh sinks
  plans/       the four jobs (piping, frac detail, well test, header mart) and
               the driver queries that run the operators on the benchmark tables
"""

__version__ = "0.1.0"
