"""Hand-written DuckDB SQL that recomputes every registered query
independently of the Spark code (the differential-test oracle)."""
