"""The operators run over the benchmark tables: inputs, queries and the SQL to check them with."""
