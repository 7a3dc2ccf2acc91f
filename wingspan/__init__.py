"""wingspan: a Spark-native load-and-harmonise engine for field-survey counts.

Raw survey tables (sites, visits, counts, a species checklist) of many
monitoring schemes are cleaned, resolved against the checklist, given
surrogate keys and published into a shared relational model, one scheme at a
time or all at once, entirely as Spark DataFrame plans.
"""

__version__ = "0.1.0"
