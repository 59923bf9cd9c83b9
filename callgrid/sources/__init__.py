"""Sources: CSV legs, landed API records, documents, sheets, driver-table adapters."""
