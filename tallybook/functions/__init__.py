"""Column-level helpers: report periods, local time, money and labels."""
