"""DataFrame-in / DataFrame-out operators (no storage access)."""
