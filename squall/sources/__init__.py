"""Sources and sinks: landed documents, stored tables, adapters over driver tables."""
