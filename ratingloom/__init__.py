"""ratingloom: batch analytics over business and customer-review tables, on Spark DataFrames."""
