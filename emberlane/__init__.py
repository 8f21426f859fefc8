"""Tags texts against gazetteers, resolves the tags to dated assets, and groups items into incidents, on Spark DataFrames."""
