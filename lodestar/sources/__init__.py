"""Sources and sinks: paged keyed source, CSV snapshots, unions, tables."""
