"""Complete ingest jobs composed from the operators."""
