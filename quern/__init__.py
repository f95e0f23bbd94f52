"""quern — corpus analytics on Spark.

DataFrame operators for multilingual news and web-page corpora: URL
canonicalisation, date resolution, keyword relevance, script/language
identification, quality grading, staged de-duplication, near-duplicate
joins, record linkage, distributions and request-log health.
"""

__version__ = "0.1.0"
