"""DataFrame -> DataFrame operators: split, clean, profile, quarantine,
consolidate, score."""
