"""Training-data operators: personal data, near duplicates, binary records, toxicity,
tokenisation, secrets, licences, decontamination and language identification.

Nothing outside this subpackage imports it; ``catalog`` registers its queries.
"""
