"""Match-shaped inputs derived from the given tables, and DuckDB SQL to compare results with."""
