"""Business jobs: each takes reference-shaped DataFrames and returns a DataFrame.

places       cleaning, key profile, duplicate keys, canonical cities, eligible customers
suppliers    nearest supplier per customer, nearest backup supplier per supplier
customers    active preference counts, customers by city rules, distances to fixed stores
preferences  top-n preferences as columns, tag index, recipe suggestion
recipes      nutrition totals per recipe
sessions     session summary, most-viewed recipe per day, daily metrics and report
catalog      the registered queries over the test data; oracle: their DuckDB SQL
"""
