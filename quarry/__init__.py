"""quarry: listing analytics on Spark.

Raw scraped listings (book and car ads, captured HTML pages) are parsed into
typed nullable tables, de-duplicated, enriched, upserted by a stable content
key and summarised, entirely with DataFrame / SQL operators.
"""

__version__ = "0.1.0"
