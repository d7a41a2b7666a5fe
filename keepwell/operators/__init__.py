"""Table-to-table operators: cleaning, star schema, features, models, reports."""
