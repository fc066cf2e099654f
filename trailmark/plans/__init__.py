"""Plan-level helpers: shared intermediate tables and the derived core tables."""
