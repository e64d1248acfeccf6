"""Generic DataFrame operators: skew-safe ordered scans and relational verbs."""
