"""Sources and sinks: bronze landing and scans, layer tables, label tables,
object-store settings and the test-data adapter."""
