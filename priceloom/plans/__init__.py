"""Named queries: each is a function of (spark, directory) with, where SQL can say it, an independent statement of the same result."""
