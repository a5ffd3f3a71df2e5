"""Training-data operators: token files, near-duplicates, decontamination,
fingerprints, substring dedup, HTML extraction, classifiers and tokenizers.

Nothing else in the package imports this subpackage; the registry entry adds
its queries only when it can be imported.
"""
