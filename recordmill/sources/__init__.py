"""Sources and sinks: framed files, notifications, requests, fixtures."""
