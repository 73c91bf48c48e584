"""Training-data pipeline operators (dedup, decontamination, mixing, scoring, sharding, archives).

Nothing else in the library imports this subpackage; its queries are listed in
``locuspark.llm.queries`` and registered by ``__spark_entry__`` when present.
"""
