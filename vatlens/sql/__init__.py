"""DuckDB SQL twins of the operators (correctness oracle)."""
