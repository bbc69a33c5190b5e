"""Sources: JDBC readers, catalog scans, activity extracts, staged data and
the assessment relations shaped from the driver tables."""
