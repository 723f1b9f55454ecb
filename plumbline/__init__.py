"""plumbline: review-quality analytics as declarative Spark plans."""
