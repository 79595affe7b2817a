"""Operators for preparing training text: quality, near duplicates, decontamination,
language, personal data, toxicity, packing, sharding, neighbours, language-model scores, spelling
variants, chat formatting and embedding whitening.

Nothing else in the library imports this package.
"""
