"""Sources and sinks: driver tables, fixture views, literal seed tables, file readers and writers."""
