"""Training-data operators on document and page tables.  Nothing else in the library imports this."""
