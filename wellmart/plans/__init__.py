"""The four jobs (piping, frac detail, well test, header mart) and the driver queries."""
