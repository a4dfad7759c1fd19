"""Training-data operators: quality, licences, near-duplicates, language
models, personal data, sharding, packing, suffix arrays, decontamination.

Nothing else in the library imports this subpackage. ``catalog`` registers
one query ``opN_<name>`` per operator.
"""
