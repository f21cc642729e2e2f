"""Sources and sinks: review files, stored pages, models."""
