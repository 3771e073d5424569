"""Sources: CSV split and variant files, the published layout, findings and progress, test-data views."""
