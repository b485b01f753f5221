"""Column expressions: ``geometry`` works on WKB, ``nested`` on arrays of points, the rest on plain columns."""
