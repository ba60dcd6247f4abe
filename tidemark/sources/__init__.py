"""Reading and writing of bars, macro tables, artifacts, models and run logs."""
