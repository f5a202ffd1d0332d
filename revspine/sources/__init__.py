"""Sources and sinks: landing-zone readers, warehouse tables, test fixtures."""
