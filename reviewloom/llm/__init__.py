"""Operators of a training-data pipeline: crawl archives, quality, language, near
duplicates, decontamination, mixing, token files and language-model scores."""
