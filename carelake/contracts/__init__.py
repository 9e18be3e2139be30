"""Contract queries: each library operator run over the test tables, with
an equivalent DuckDB SQL text for the side-by-side correctness check."""
