"""Column helpers and join-side sizing (size-checked broadcast, stored side tables)."""
