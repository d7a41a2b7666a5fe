"""DuckDB SQL that recomputes every deterministic operator."""
