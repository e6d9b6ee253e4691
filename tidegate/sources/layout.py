"""How much of a place goes into one file, and how files are compressed."""

ROWS_PER_FILE = 1_000_000
# Messages and lines repeat the same names: they take about half of what Spark's default, snappy, makes of them.
CODEC = "zstd"
