"""Sinks: landed extracts, versioned period tables, manifest, CSV export."""
