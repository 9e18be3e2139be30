"""Training-data pipeline operators: one module per operator, each a general
function over DataFrames, and ``queries`` with the thin registered queries."""
