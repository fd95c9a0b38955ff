"""cdmspark: clinical common-data-model ETL and concept mapping as Spark jobs.

Layout
  functions/  Column -> Column helpers (rule maps, text cleaning, dates, scores)
  sources/    readers (driver tables, vocabulary files), sinks (create/append/rejects)
  operators/  relational building blocks (islands, dense ids, anti-join appends,
              nearest / fuzzy joins, embeddings, mapping, reports, data quality)
  plans/      end-to-end table jobs and the registered queries over the test tables
  streaming/  incremental append as a Structured Streaming job
"""

__all__ = ["session"]
