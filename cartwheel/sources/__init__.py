"""Sources and sinks: tables, the sessions view, CSV, JSON reports, artifacts, run log."""
