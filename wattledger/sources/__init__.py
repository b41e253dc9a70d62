"""Table schemas, contract checks, capture files and sinks."""
