"""Sources and sinks: driver tables, the accounts view, CSV scan, submission sinks."""
