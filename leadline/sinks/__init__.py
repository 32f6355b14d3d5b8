"""Writers: stored events, quarantine, tables, session records, snapshots."""
