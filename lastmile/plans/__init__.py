"""Table-level plans: warehouse normalisation, incremental upsert, marts, jobs."""
