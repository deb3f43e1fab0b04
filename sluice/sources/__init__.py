"""Sources: contracts, file scans, inventories and the derived telemetry view."""
