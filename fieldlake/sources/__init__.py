"""Sources and sinks: raw JSON landing, typed CSV, GeoJSON, seeds, table writes."""
