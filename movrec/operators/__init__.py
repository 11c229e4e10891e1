"""Set-based reconciliation operators (transforms A and B, change sets, apply)."""
