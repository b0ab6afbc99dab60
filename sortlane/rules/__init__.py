"""Fixed values of the rule tiers: patterns, class names and lookup tables only."""
