"""Training-data operators: ten corpus-scale jobs and their registered queries.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when present.
"""
