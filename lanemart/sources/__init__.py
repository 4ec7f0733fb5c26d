"""Reading: catalog tables, parquet registries, warehouse relations, sheets, literal dimensions."""
