"""Column -> Column scalar functions (string, date, math, geo, array, JSON)."""
