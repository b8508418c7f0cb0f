"""Column functions: dates, money, classifications."""
