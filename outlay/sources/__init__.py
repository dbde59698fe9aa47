"""Reading cost, account and rate tables; writing reports."""
