"""Analytics over large corpora of human-assistant conversations, on Spark DataFrames."""
