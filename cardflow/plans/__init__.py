"""The pipeline steps: ingest (validation), transform (enrichment and
metrics), reports, sinks and the step runner."""
