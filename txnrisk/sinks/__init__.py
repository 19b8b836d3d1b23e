"""Writers: append, quarantine, upsert, metrics and model tables, maintenance."""
