"""Composite queries (MRR variants, ETL) and the query registry with its SQL oracle."""
