"""sousflow: analytics jobs for a recipe-delivery business, written on Spark DataFrames.

Layers
------
functions/  Column -> Column expressions (text cleaning, distance, time, JSON).
operators/  DataFrame -> DataFrame building blocks (dedup, top-n, pivot, explode,
            exact nearest-location join).
sources/    table loading and the views that shape the generated test tables.
plans/      the business jobs, each a composition of operators.
llm/        operators for language-model training data, on their own: nothing else imports them.

The jobs are batch only.
"""

__all__ = ["functions", "operators", "sources", "plans"]
