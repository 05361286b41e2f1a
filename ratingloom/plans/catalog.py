"""All registered queries: name -> (query, checking SQL or None)."""

from __future__ import annotations

from ratingloom.plans import (cleaning_queries, dirichlet_queries, index_queries, job_queries, place_queries, similar_queries,
                              text_queries, trend_queries)

QUERIES = {
    **trend_queries.QUERIES, **cleaning_queries.QUERIES, **place_queries.QUERIES,
    **text_queries.QUERIES, **dirichlet_queries.QUERIES, **similar_queries.QUERIES, **job_queries.QUERIES,
    **index_queries.QUERIES,
}
