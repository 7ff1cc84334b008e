"""Tables in and out: CSV and JSON files, metric documents, the model registry."""
