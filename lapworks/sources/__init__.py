"""Sources and sinks: landed JSON payloads, the REST list source, tables, catalog."""
