"""DuckDB SQL restating each registered query's expected result."""
