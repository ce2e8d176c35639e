"""Population-scale genetic variation analytics as PySpark DataFrame transforms."""
