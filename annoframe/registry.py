"""All queries over the given tables, with the SQL that checks them."""

from annoframe.plans import corpus_queries, date_queries, entity_queries, layout_queries, record_queries, source_queries, store_queries  # noqa: F401
from annoframe.plans.base import ORACLES, QUERIES  # noqa: F401
