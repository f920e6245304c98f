"""Entity plans: each turns source tables into one output table."""
