"""Writing: lake tables, warehouse appends, replace-since loads, lineage cuts."""
