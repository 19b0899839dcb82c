"""Training-data operators: tokens, decontamination, chat, fixity, near-duplicates, scoring.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when it is present.
"""
