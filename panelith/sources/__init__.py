"""Table schemas, partitioned stores with their ledger, and adapters that derive a panel from relational tables."""
