"""Period pipelines, report assembly and the registered query catalogue."""
