"""Training-data operators: token counts, fingerprints, transcripts, toxicity,
language ID, repeated text, near duplicates, mixing and decontamination.

Nothing else in the library imports this subpackage.
"""
