"""Column functions: text, dates, places, labels, scores, rendering."""
