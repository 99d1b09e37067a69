"""Column expressions: Column in, Column out, evaluated inside Spark's own operators."""
