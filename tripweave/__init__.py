"""Trip and weather analytics as lazy DataFrame-to-DataFrame functions on Spark."""
