"""Plan shapes shared by many operators (skew-safe keyed scans)."""
