"""Multi-step jobs: dashboard queries, profiling reports, catalog and the monthly run."""
