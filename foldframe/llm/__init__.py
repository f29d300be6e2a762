"""Training-data operators: token counts, deduplication, packing, scoring, tokenising, sharding, sketches, toxicity.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries only if it is there.
"""
