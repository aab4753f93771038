"""Topic to table pipelines."""
