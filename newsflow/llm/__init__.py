"""Operations of a training-data pipeline (quality, mixing, decontamination,
extraction, toxicity, token counts, URL filters, near-duplicates, licences, vector
codes, repeated strings, periodic runs).

Nothing outside this subpackage imports it, apart from the guarded import in
``__spark_entry__.py``.
"""
