"""Operators of a training-data pipeline over documents, pages, embeddings and conversations.

``queries()`` and ``oracle_sql()`` give the registered queries; nothing else of the
library imports this subpackage.
"""

from . import (  # noqa: F401
    bpe,
    jaccard,
    lines,
    mixing,
    phrases,
    resampling,
    rules,
    spherical,
    target_draw,
    token_files,
    tool_calls,
    toxic_spans,
    url_filter,
)
from .common import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(SQL)
