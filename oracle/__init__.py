"""Expected results as DuckDB SQL over the same Parquet tables."""
