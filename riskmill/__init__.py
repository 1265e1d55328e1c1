"""Risk analytics for labelled tables on Spark."""
