"""citeloom: bibliographic record analytics as PySpark DataFrame transforms."""
