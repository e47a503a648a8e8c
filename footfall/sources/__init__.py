"""Sources: tolerant text slices, catalog tables, day state and test fixtures."""
