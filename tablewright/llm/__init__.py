"""Operators of a training-data pipeline: sharding, near duplicates, packing, quality, licences, secrets, language, decontamination, PII."""
