"""Sources and sinks: test tables, landing envelopes, raw tables, mart storage."""
