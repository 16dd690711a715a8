"""Reading brand tables and daily snapshots; writing reports."""
