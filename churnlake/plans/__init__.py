"""End-to-end plans: the query catalog, the modelling pipelines, sweeps."""
