"""Operations of a training-data pipeline: search, fingerprints, deduplication, personal data,
chat formatting, tokenizers, language identification and packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
