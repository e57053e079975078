"""Reading and writing: CSV ingest, stored layers, exports, test-table adapter."""
