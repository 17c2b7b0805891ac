"""End-to-end load and the registered queries."""
