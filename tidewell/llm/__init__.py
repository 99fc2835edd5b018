"""Training-data operators for web-scale corpora.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries when it is present.
"""
