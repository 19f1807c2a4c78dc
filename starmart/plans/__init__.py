"""Star adapters, analytic queries, views, marts and the batch pipeline."""
